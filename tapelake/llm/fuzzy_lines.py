"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, one occurrence per connected group.

1. Every line of every text is normalised (lower case, digits as 0, ASCII punctuation as spaces, single spaces), hashed, and given a
   64-bit SimHash of its distinct words (counted words would make all long lines alike by their common words). Lines whose
   normalised form has fewer than ``LEAST`` characters have no SimHash and are never compared with different ones; equal ones
   are one group, or all stay unless ``short``. Equal normalised lines become one row, before anything else is joined.
2. Two SimHashes that differ in at most ``DISTANCE`` bits agree in ``take`` of ``DISTANCE + take`` blocks, whichever bits differ. A
   line is sent to one bucket per choice of ``take`` blocks. ``take`` grows with the number of lines so that buckets stay small;
   the pairs found are the same for every ``take``. Buckets of more than ``SPLIT`` lines are cut into blocks that meet in pairs.
   A long bucket is cut by a second block (or, for pairs that agree in no other, by the parities of the blocks), so that fewer lines meet; and of
   these, sorted by length, only those whose lengths allow the similarity: a longer line has at most 1 / ``SIMILARITY`` times as many characters.
3. A line with at most ``FEW`` neighbours in a bucket is paired with all of them; lines with more are paired with the smallest
   one. Pairs whose normalised lines reach ``SIMILARITY`` (1 - edit distance / longer length) are links.
4. Of the lines with more neighbours, pairs that the links so far leave in different groups are verified too, so every pair of
   the join is linked, in one group already, or verified as too different, and no group is expanded into all its pairs.
5. Of each connected group the first occurrence stays, by doc_id (nulls last), text and line number.

A 64-bit hash stands for a normalised line.

Of pairs that reach ``SIMILARITY``, 91 % are within ``DISTANCE`` bits, 37 % within 4 (349 pairs of sf0.01 that share a rare pair of words).

Defined results: null and empty texts have no lines; blank lines always stay; rows that repeat a doc_id and a text are one document,
each gets the same lines; a document that loses all its lines is dropped by ``dedup_lines``, documents without text stay. Further
columns are passed through; only ``n_chars``, if there is one, follows the text.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import components, few, freed, in_blocks, shuffle_partitions, small_batches, sorted_runs, spare
from tapelake.llm.shingles import as_bytes
from tapelake.plans.staging import stage

LEAST = 20
DISTANCE = 10
SIMILARITY = 0.8
FEW = 4
SPLIT = 1 << 20
# Lines per bucket that the choice of ``take`` aims at.
AIM = 1 << 19

_UPPER_TO_LOWER = bytes(range(256)).lower()
_TABLE = bytes(
    b if b == ord("\n") else ord("0") if chr(b).isdigit() and b < 128 else _UPPER_TO_LOWER[b] if b >= 128 or chr(b).isalnum() else ord(" ") for b in range(256)
)


def _lowered(text: bytes) -> bytes:
    return text if text.isascii() else text.decode("utf-8", "replace").lower().encode("utf-8", "replace")


def normalised_lines(text: bytes | None) -> list[list[bytes]]:
    """The words of the normalised form of each line."""
    if not text:
        return []
    return [line.split() for line in _lowered(text).translate(_TABLE).split(b"\n")]


def _whole_lines(texts: list[bytes]) -> list[bytes]:
    """The normalised forms of the lines of all texts, one text after another; a null or empty one must not be among them."""
    if not texts:
        return []
    data = np.frombuffer(b"\n".join(map(_lowered, texts)).translate(_TABLE), np.uint8)
    word, end = data > ord(" "), data == ord("\n")
    kept = word | end
    kept[1:] |= word[:-1]  # the first space behind a word
    data, end = data[kept], end[kept]
    kept = data != ord(" ")
    kept[:-1] |= ~end[1:]  # but not at the end of a line
    return data[kept].tobytes().split(b"\n")


# Each byte as its eight bits in eight bytes, so that bits are counted eight at a time, up to 255 of each.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
_COUNTED = 255


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(values: np.ndarray, bits: int) -> np.ndarray:
    return values << np.uint64(bits) | values >> np.uint64(64 - bits)


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The XXH64 of words that lie in an array of bytes, computed for all words of a length at once; words of 32 bytes or more go one by one."""
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(np.minimum(lengths, 32).astype(np.uint8), kind="stable")
    ends = np.searchsorted(lengths[order], np.arange(33), side="left")
    for length in range(1, 32):
        rows = order[ends[length] : ends[length + 1]]
        if not len(rows):
            continue
        at, left = starts[rows], length
        value = np.full(len(rows), _P5 + np.uint64(length))
        while left >= 8:
            lane = data[at[:, None] + np.arange(8)].view(np.uint64).ravel()
            value = _turned(value ^ _turned(lane * _P2, 31) * _P1, 27) * _P1 + _P4
            at, left = at + 8, left - 8
        if left >= 4:
            lane = data[at[:, None] + np.arange(4)].view(np.uint32).ravel().astype(np.uint64)
            value = _turned(value ^ lane * _P1, 23) * _P2 + _P3
            at, left = at + 4, left - 4
        for k in range(left):
            value = _turned(value ^ data[at + k].astype(np.uint64) * _P5, 11) * _P1
        value = (value ^ value >> np.uint64(33)) * _P2
        value = (value ^ value >> np.uint64(29)) * _P3
        out[rows] = value ^ value >> np.uint64(32)
    for row in order[ends[32] :]:
        out[row] = xxhash.xxh64_intdigest(data[starts[row] : starts[row] + lengths[row]].tobytes())
    return out


def _once(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One place of each (group, value), ascending. Those that share a slot of a table go on to the next one."""
    slots = np.uint64(max(2 * len(value) - 1, 1)).item().bit_length()
    table = np.empty(1 << slots, np.int64)
    kept, rows, spread = np.zeros(len(value), bool), np.arange(len(value)), value + group.astype(np.uint64) * _P1
    while len(rows):
        spread = (spread ^ spread >> np.uint64(32)) * _P2
        slot = spread >> np.uint64(64 - slots)
        table[slot] = rows
        winner = table[slot]
        kept[winner] = True
        other = (value[winner] != value[rows]) | (group[winner] != group[rows])
        rows, spread = rows[other], spread[other]
    return np.flatnonzero(kept)


def _simhashes(wholes: list[bytes]) -> np.ndarray:
    """A 64-bit SimHash of the distinct words of each of some lines that have words, with one space between them."""
    if not wholes:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"\n".join(wholes), np.uint8)
    gaps = np.flatnonzero(data <= ord(" "))
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    line = np.append(0, np.cumsum(data[gaps] == ord("\n")))
    hashes = word_hashes(data, starts, ends - starts)
    once = _once(line, hashes)
    spread = _SPREAD[hashes[once].view(np.uint8)].reshape(-1, 8)
    sizes = np.bincount(line[once])
    parts = -(-sizes // _COUNTED)  # of each line
    first = np.cumsum(parts) - parts
    starts = np.repeat(np.cumsum(sizes) - sizes - first * _COUNTED, parts) + np.arange(parts.sum()) * _COUNTED
    bits = np.add.reduceat(spread, starts, axis=0).view(np.uint8).reshape(-1, 64)
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > sizes[:, None], axis=1).view(np.uint64).ravel()


def simhashes(lines: list[list[bytes]]) -> np.ndarray:
    """A 64-bit SimHash of each line's distinct words; 0 without words."""
    out = np.zeros(len(lines), np.uint64)
    out[[k for k, words in enumerate(lines) if words]] = _simhashes([b" ".join(words) for words in lines if words])
    return out


# Characters of text whose words are hashed at a time, so that what is between stays in the cache.
TEXTS = 1 << 19

LINE = "doc_id long, tie long, line_no int, line long, sim long, size int"


def _line_rows(least: int, short: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TEXTS):
            texts = as_bytes(batch.column("text"))
            having = np.array([k for k, text in enumerate(texts) if text], np.int64)
            texts = [text for text in texts if text]
            wholes = _whole_lines(texts)
            # Which text each line is of, and its number there.
            counts = np.array([text.count(b"\n") + 1 for text in texts], np.int64)
            docs, numbers = np.repeat(having, counts), np.arange(len(wholes)) - np.repeat(np.cumsum(counts) - counts, counts)
            full = np.array([whole != b"" for whole in wholes], bool)
            docs, numbers, wholes = docs[full], numbers[full], [whole for whole in wholes if whole]
            size = np.array([len(whole) if whole.isascii() else len(whole.decode("utf-8", "replace")) for whole in wholes], np.int32)
            sims = _simhashes(wholes).view(np.int64)
            key = np.fromiter(map(xxhash.xxh3_64_intdigest, wholes), np.uint64, len(wholes)).view(np.int64)
            at = pa.array(docs)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(at),
                    "tie": batch.column("tie").take(at),
                    "line_no": pa.array(numbers.astype(np.int32)),
                    "line": pa.array(key, mask=(size < least) & (not short)),
                    "sim": pa.array(sims, mask=size < least),
                    "size": pa.array(size),
                }
            )

    return rows


def _texts(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def lines(documents: DataFrame, least: int = LEAST, short: bool = True) -> DataFrame:
    """A row per line that isn't blank: doc_id, tie (of the text), line_no, line, sim and size in characters. Short lines have no sim,
    and a line only if ``short``."""
    return _texts(documents).mapInArrow(freed(_line_rows(least, short)), LINE)


def _line_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        wholes = list(dict.fromkeys(whole for whole in _whole_lines([text for text in as_bytes(batch.column("text")) if text]) if whole))
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, wholes), np.uint64, len(wholes))
        yield pa.record_batch({"line": pa.array(keys.view(np.int64)), "norm": pa.array(wholes, pa.binary()).cast(pa.string())})


# ---- buckets ------------------------------------------------------------------------------------------------------------
def choose_take(count: int, distance: int = DISTANCE) -> int:
    """The fewest blocks per key that keep buckets near ``AIM`` lines; the pairs found don't depend on it."""
    take = 1
    while take < distance and count > AIM * 2 ** (64 * take / (distance + take)):
        take += 1
    return take


def _edges(blocks: int) -> list[int]:
    """Where the blocks of a SimHash begin and end."""
    return [64 * k // blocks for k in range(blocks + 1)]


def bucket_keys(sim, distance: int, take: int):
    """Array column of the keys of a SimHash column, one for each choice of ``take`` of ``distance + take`` blocks."""
    blocks = distance + take
    edges = _edges(blocks)
    values = [F.shiftrightunsigned(sim, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in itertools.pairwise(edges)]
    widest = take * -(-64 // blocks)
    keys = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), take)):
        key = F.lit(0).cast("long")
        for k in chosen:
            key = F.shiftleft(key, edges[k + 1] - edges[k]).bitwiseOR(values[k])
        keys.append(key + F.lit(number << widest).cast("long"))
    return F.array(*keys)


# Near pairs that a task keeps at a time; of more it keeps none and finds them again.
PAIRS = 1 << 21
# Runs from this length on are compared row by row against the run, shorter ones all at once, step by step.
LONG_RUN = 32
# Runs from this length on are cut by parts of their bits first; shorter ones are compared sooner than cut.
WIDE_RUN = 1 << 12


# Each of how many rows is compared with how many later ones at a time, so that what is between stays in the cache: steps, rows.
TILE = (32, 2048)


def _reach(size: np.ndarray, similarity: float) -> np.ndarray:
    """For each of the ascending sizes, up to where larger ones allow the similarity."""
    return np.searchsorted(size, np.floor(size / similarity + 1e-6), side="right")


def _all_near(run: np.ndarray, reach: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j < reach[i], that are near."""
    steps, rows = TILE
    differ, bits = np.empty(steps * rows, np.uint64), np.empty(steps * rows, np.uint8)  # used again and again
    width = reach - np.arange(len(run))
    padded = np.append(run, np.zeros(width.max(initial=0), np.uint64))
    for begin in range(0, len(run), rows):
        wide = width[begin : begin + rows]
        last = wide.max()
        for step in range(1, last, steps):
            live = np.flatnonzero(wide > step)
            first, part = begin + live[0], run[begin + live[0] : begin + live[-1] + 1]
            shape = (min(steps, last - step), len(part))
            cells = shape[0] * shape[1]
            others = np.ndarray(shape, np.uint64, padded, 8 * (first + step), (8, 8))  # each row begins one later than that before
            np.bitwise_count(np.bitwise_xor(part, others, out=differ[:cells].reshape(shape)), out=bits[:cells].reshape(shape))
            if bits[:cells].min() <= distance:
                ahead, i = np.divmod(np.flatnonzero(bits[:cells] <= distance), shape[1])
                i = i + first
                j = i + ahead + step
                kept = j < reach[i]
                if kept.any():
                    yield i[kept], j[kept]


def _near_in_cut(key: np.ndarray, run: np.ndarray, size: np.ndarray, distance: int, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of equal (small, not negative) keys, as places in ``run``, which is in order of size; up to ``PAIRS`` or so at a time."""
    order = np.argsort(key, kind="stable")  # rows of a key stay in order of size
    runs, sizes, keys = run[order], size[order].astype(np.int64), key[order].astype(np.int64) << 32
    reach = np.searchsorted(keys | sizes, keys | np.floor(sizes / similarity + 1e-6).astype(np.int64), side="right")
    held, count = [], 0
    for i, j in _all_near(runs, reach, distance):
        held.append((i, j))
        count += len(i)
        if count > PAIRS:
            yield tuple(order[np.concatenate(part)] for part in zip(*held, strict=True))
            held, count = [], 0
    if held:
        yield tuple(order[np.concatenate(part)] for part in zip(*held, strict=True))


def _near_in_run(run: np.ndarray, size: np.ndarray, distance: int, similarity: float, first: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of rows in order of size that are near and whose sizes allow the similarity.

    A long run is cut by each of ``distance + 1`` blocks of the bits, and a pair is told by the first block that it agrees in. If all
    rows agree in a block, as those of a bucket of one block do, it is told by the first other one; a pair that agrees in no other differs
    in exactly one bit of each, so the rows have opposite parities in all of them. ``first``: pairs that agree in a block before that of
    the run are told in that block's bucket and may be left out.
    """
    reach = _reach(size, similarity)
    varying = np.bitwise_or.reduce(run ^ run[0])
    if len(run) < WIDE_RUN or np.bitwise_count(varying) <= distance:
        yield from _all_near(run, reach, distance)
        return
    edges = _edges(distance + 1)
    masks = [np.uint64((1 << b) - (1 << a)) for a, b in itertools.pairwise(edges)]
    agreed = next((k for k, mask in enumerate(masks) if not varying & mask), None)
    if agreed is None:
        bits = np.flatnonzero(np.unpackbits(varying.reshape(1).view(np.uint8), bitorder="little")).astype(np.uint64)
        masks = [np.bitwise_or.reduce(np.uint64(1) << part) for part in np.array_split(bits, distance + 1)]
    others = [k for k in range(distance + 1) if k != agreed]
    keys = {}
    for k in others:
        if agreed is None or not first or k > agreed:
            keys[k] = np.unique(run & masks[k], return_inverse=True)[1].astype(np.min_scalar_type(len(run))) if agreed is None else ((run & masks[k]) >> np.uint64(edges[k])).astype(np.uint16)
    if sum((np.bincount(key).astype(float) ** 2).sum() for key in keys.values()) >= float(len(run)) ** 2:
        yield from _all_near(run, reach, distance)
        return
    if agreed is not None:
        parity = np.zeros(len(run), np.int64)
        for k in others:
            parity = parity << 1 | np.bitwise_count(run & masks[k]) & 1
        keys[None] = np.minimum(parity, parity ^ ((1 << len(others)) - 1))
    for k, key in keys.items():
        for i, j in _near_in_cut(key, run, size, distance, similarity):
            differ, new = run[i] ^ run[j], np.ones(len(i), bool)
            for other in others[: others.index(k)] if k is not None else others:
                new &= differ & masks[other] != 0
            i, j = i[new], j[new]
            yield np.minimum(i, j), np.maximum(i, j)


def _neighbours(sim: np.ndarray, size: np.ndarray, ends: np.ndarray, side: np.ndarray, distance: int, similarity: float, first: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (i, j), i < j, of one run that are near and of fitting sizes; rows of two blocks only meet across the blocks."""
    starts = np.flatnonzero(np.append(True, ends[1:] != ends[:-1])) if len(ends) else ends
    lengths = ends[starts] - starts
    for start, length in zip(starts[lengths >= LONG_RUN], lengths[lengths >= LONG_RUN], strict=True):
        run = slice(start, start + length)
        for i, j in _near_in_run(sim[run], size[run], distance, similarity, first):
            yield _across(i + start, j + start, side)
    rows, step = np.flatnonzero(np.repeat(lengths < LONG_RUN, lengths)), 1
    while len(rows := rows[rows + step < ends[rows]]):
        rows = rows[size[rows + step] <= np.floor(size[rows] / similarity + 1e-6)]  # further ones are larger still
        found = rows[np.bitwise_count(sim[rows] ^ sim[rows + step]) <= distance]
        yield _across(found, found + step, side)
        step += 1


def _across(i: np.ndarray, j: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kept = (side[i] < 0) | (side[i] != side[j])
    return i[kept], j[kept]


def _sized_runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Whole buckets at a time, as the end of each row's bucket instead of the bucket, size, and the other columns; in order of size within a bucket."""
    for bucket, size, *others in sorted_runs(batches, ("bucket", "size", *names)):
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(starts, len(bucket)))
        order = np.argsort(np.repeat(np.arange(len(starts)) << 32, lengths) | size)
        yield [np.repeat(starts + lengths, lengths), *(column[order] for column in (size, *others))]


PAIR = "a long, b long, crowded boolean"


def _near_pairs(distance: int, similarity: float, crowd: int, first: bool):
    """Step 3. Rows with a true flag and a = b tell the lines that have more neighbours."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ends, size, line, sim, side in _sized_runs(batches, ("line", "sim", "side")):
            sims = sim.view(np.uint64)
            degree, smallest = np.zeros(len(line), np.int64), line.copy()
            held, count = [], 0  # the pairs found, if they aren't too many to keep
            for i, j in _neighbours(sims, size, ends, side, distance, similarity, first):
                count += len(i)
                if len(i) and count <= PAIRS:
                    held.append((i, j))
                np.add.at(degree, i, 1)
                np.add.at(degree, j, 1)
                np.minimum.at(smallest, i, line[j])
                np.minimum.at(smallest, j, line[i])
            crowded = degree > crowd
            out = [(line[crowded], smallest[crowded], np.zeros(crowded.sum(), bool)), (line[crowded], line[crowded], np.ones(crowded.sum(), bool))]
            for i, j in held if count <= PAIRS else _neighbours(sims, size, ends, side, distance, similarity, first):
                kept = ~(crowded[i] & crowded[j])
                out.append((line[i[kept]], line[j[kept]], np.zeros(kept.sum(), bool)))
            yield from _pair_batches(out)

    return rows


def _pair_batches(out: list[tuple]) -> Iterator[pa.RecordBatch]:
    a, b, crowded = (np.concatenate(part) for part in zip(*out, strict=True))
    kept = (a != b) | crowded
    a, b, crowded = a[kept], b[kept], crowded[kept]
    for start in range(0, len(a), 100_000):
        part = slice(start, start + 100_000)
        yield pa.record_batch({"a": pa.array(np.minimum(a[part], b[part])), "b": pa.array(np.maximum(a[part], b[part])), "crowded": pa.array(crowded[part])})


def _far_pairs(distance: int, similarity: float, first: bool):
    """Step 4: near pairs of different groups."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ends, size, line, sim, side, group in _sized_runs(batches, ("line", "sim", "side", "group")):
            for i, j in _neighbours(sim.view(np.uint64), size, ends, side, distance, similarity, first):
                apart = group[i] != group[j]
                if apart.any():
                    yield from _pair_batches([(line[i[apart]], line[j[apart]], np.zeros(apart.sum(), bool))])

    return rows


def dealt(sims: DataFrame, distance: int, take: int, split: int) -> DataFrame:
    """Rows (line, sim, size, ...) in their buckets."""
    rows = sims.withColumn("bucket", F.explode(bucket_keys(F.col("sim"), distance, take)))
    rows = in_blocks(rows, "bucket", "line", split)
    return rows.repartition(shuffle_partitions(sims.sparkSession), "bucket").sortWithinPartitions("bucket")


def _same_start(x: str, y: str) -> int:
    """Characters that two texts have in common from the start."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if x[low:middle] == y[low:middle] else (low, middle - 1)
    return low


def _trimmed(x: str, y: str) -> tuple[str, str]:
    """Two texts without what both have at their ends."""
    start = _same_start(x, y)
    x, y = x[start:], y[start:]
    end = _same_start(x[::-1], y[::-1])
    return x[: len(x) - end], y[: len(y) - end]


# Columns after which the rows near the diagonal are chosen anew.
STRIP = 256


def edit_distance(x: str, y: str, room: int | None = None) -> int:
    """Levenshtein distance, a column of the table at a time as the bits of whole numbers: where it grows by one from a row to the next,
    and where it gets less. A distance above ``room`` is only told to be above it: rows that are too far from the diagonal to go there and
    back are left out, as if they grew by one in each column."""
    room = max(len(x), len(y)) if room is None else room
    longer = len(x) - len(y)
    if abs(longer) > room:
        return room + 1
    aside = (room - abs(longer)) // 2
    below, above = aside + max(longer, 0), aside + max(-longer, 0)
    places: dict[str, int] = {}
    for at, char in enumerate(x):
        places[char] = places.get(char, 0) | 1 << at
    low = high = up = down = 0
    score = len(y)
    for start in range(0, max(len(y), 1), STRIP):
        gone, more = max(0, start - above) - low, min(len(x), start + STRIP + below) - high
        score += (up & (1 << gone) - 1).bit_count() - (down & (1 << gone) - 1).bit_count()
        up = (up | (1 << more) - 1 << high - low) >> gone
        down >>= gone
        low, high = low + gone, high + more
        every = (1 << high - low) - 1
        near = {char: bits >> low & every for char, bits in places.items()}
        for char in y[start : start + STRIP]:
            equal = near.get(char, 0)
            across = (((equal & up) + up) ^ up) | equal | down
            more, less = down | ~(across | up) & every, up & across
            more, less = (more << 1 | 1) & every, less << 1 & every
            equal |= down
            up, down = less | ~(equal | more) & every, more & equal
    return score + up.bit_count() - down.bit_count()


def alike(x: str, y: str, similarity: float) -> bool:
    """Is the edit similarity reached? What both have at their ends costs nothing, and a short rest needs no table."""
    room = math.floor(round((1 - similarity) * max(len(x), len(y)), 6))
    if abs(len(x) - len(y)) > room:
        return False
    x, y = _trimmed(x, y)
    return max(len(x), len(y)) <= room or edit_distance(x, y, room) <= room


# Pairs whose edit distances are computed together: the most, and the characters of one text of each. Texts longer than ``TEXT`` go one by one.
TOGETHER, CHARS, TEXT = 1 << 11, 1 << 21, 1 << 11


def _numbered(texts: list[str], pairs: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The characters of the texts (the first ones of all pairs, then the second ones), numbered from 0 within each pair, where each
    text begins and ends, and how many numbers there are."""
    whole = "".join(texts)
    codes = np.frombuffer(whole.encode(), np.uint8) if whole.isascii() else np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    used = np.zeros(int(codes.max(initial=0)) + 1, bool)
    used[codes] = True
    number = np.cumsum(used) - 1
    sizes = np.array([len(text) for text in texts], np.int64)
    at = np.repeat(np.tile(np.arange(pairs), 2) * (number[-1] + 1), sizes) + number[codes]
    held = np.zeros((pairs, number[-1] + 1), bool)
    held.ravel()[at] = True
    own = np.cumsum(held, axis=1, dtype=np.int32)
    return own.ravel()[at] - 1, np.append(0, np.cumsum(sizes)), int(own.max(initial=0))


def edit_distances(xs: list[str], ys: list[str], room: int | np.ndarray) -> np.ndarray:
    """Levenshtein distances of pairs of texts, like ``edit_distance``, a column of all tables at a time; best of texts of like lengths
    and with like ``room``, of each pair or of all."""
    length = np.array([len(y) for y in ys], np.int64)
    down = np.argsort(-length, kind="stable")  # the pairs that still have a column stay in front
    xs, ys, length = [xs[k] for k in down], [ys[k] for k in down], length[down]
    count = len(xs)
    codes, edges, kinds = _numbered(xs + ys, count)
    sizes, begins = np.diff(edges[: count + 1]), edges[count:-1]
    words = -(-int(sizes.max(initial=1)) // 64)
    longer, room = sizes - length, np.broadcast_to(room, count)[down]
    aside = np.maximum(room - np.abs(longer), 0) // 2
    fits = np.abs(longer) <= room  # of the others any result is above it
    below, above = (int((aside + np.maximum(side, 0))[fits].max(initial=0)) for side in (longer, -longer))
    one, top = np.uint64(1), np.uint64(63)
    places = np.zeros((words, count * kinds), np.uint64)  # of each number in the first text of each pair
    own = np.arange(count) * kinds
    short = np.argsort(sizes, kind="stable")
    for at in range(int(sizes.max(initial=0))):
        having = short[np.searchsorted(sizes[short], at, side="right") :]
        places[at // 64, own[having] + codes[edges[having] + at]] |= one << np.uint64(at % 64)
    up, less = np.full((words, count), ~np.uint64(0)), np.zeros((words, count), np.uint64)
    for at in range(int(length.max(initial=0))):
        live = int(np.searchsorted(-length, -at, side="left"))  # texts of more than ``at`` characters
        chars = own[:live] + codes[begins[:live] + at]
        # From the word below; the first row grows by one a column.
        carry_up, carry_down = np.ones(live, np.uint64), np.zeros(live, np.uint64)
        for word in range(max(0, at - above) // 64, min(words, (at + below) // 64 + 1)):
            equal, p, m = places[word].take(chars), up[word, :live], less[word, :live]
            vertical = equal | m
            equal |= carry_down
            across = equal & p
            across += p
            across ^= p
            across |= equal
            minus = p & across
            across |= p
            plus = np.invert(across, out=across)
            plus |= m
            next_up, next_down = plus >> top, minus >> top
            plus <<= one
            plus |= carry_up
            minus <<= one
            minus |= carry_down
            np.bitwise_and(plus, vertical, out=m)
            vertical |= plus
            np.invert(vertical, out=vertical)
            np.bitwise_or(minus, vertical, out=p)
            carry_up, carry_down = next_up, next_down
    # The last column's last value: its first one and the steps down to the end of the first text.
    out = length.copy()
    for word in range(words):
        bits = np.clip(sizes - 64 * word, 0, 64)
        mask = np.where(bits == 64, ~np.uint64(0), (one << np.minimum(bits, 63).astype(np.uint64)) - one)
        out += np.bitwise_count(up[word] & mask).astype(np.int64) - np.bitwise_count(less[word] & mask)
    back = np.empty_like(out)
    back[down] = out
    return back


def all_alike(xs: list[str], ys: list[str], similarity: float) -> np.ndarray:
    """``alike`` of many pairs."""
    sizes = np.array([(len(x), len(y)) for x, y in zip(xs, ys, strict=True)], np.int64).reshape(-1, 2)
    room = np.floor(np.round((1 - similarity) * sizes.max(axis=1), 6)).astype(np.int64)
    fitting = np.flatnonzero(np.abs(sizes[:, 0] - sizes[:, 1]) <= room)
    rests = [_trimmed(*sorted((xs[k], ys[k]), key=len)) for k in fitting]
    longer = np.array([max(len(x), len(y)) for x, y in rests], np.int64)
    out = np.zeros(len(xs), bool)
    out[fitting[longer <= room[fitting]]] = True
    for k in np.flatnonzero((longer > room[fitting]) & (longer > TEXT)):
        out[fitting[k]] = edit_distance(*rests[k], int(room[fitting[k]])) <= room[fitting[k]]
    asked = np.flatnonzero((longer > room[fitting]) & (longer <= TEXT))
    asked = asked[np.argsort(-room[fitting[asked]] - np.abs(sizes[:, 0] - sizes[:, 1])[fitting[asked]], kind="stable")]
    while len(asked):
        count = min(TOGETHER, CHARS // int(longer[asked].max()))
        part, asked = asked[:count], asked[count:]
        limit = room[fitting[part]]
        out[fitting[part]] = edit_distances([rests[k][0] for k in part], [rests[k][1] for k in part], limit) <= limit
    return out


def _alike_rows(similarity: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = all_alike(batch.column("x").to_pylist(), batch.column("y").to_pylist(), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return rows


def similar(documents: DataFrame, distinct: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of lines whose normalised forms reach the edit similarity; only documents that hold a first occurrence of
    one of them are read."""
    asked = pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct()
    asked = stage(asked.join(distinct.select("line", "place"), "line").select("line", F.col("place.doc_id").alias("held")), "asked")
    holders = stage(asked.select("held").distinct(), "holders")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(few(holders), F.col("doc_id").eqNullSafe(F.col("held")), "left_semi").select("text")
    norms = texts.mapInArrow(freed(_line_texts), "line long, norm string").join(few(asked.select("line")), "line", "left_semi")
    norms = stage(norms.groupBy("line").agg(F.first("norm").alias("norm")), "norms")
    joined = pairs.join(norms.select(F.col("line").alias("a"), F.col("norm").alias("x")), "a").join(norms.select(F.col("line").alias("b"), F.col("norm").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(freed(_alike_rows(similarity)), "a long, b long")


def line_groups(documents: DataFrame, distinct: DataFrame, distance: int = DISTANCE, similarity: float = SIMILARITY, crowd: int = FEW, split: int = SPLIT, take: int | None = None) -> DataFrame:
    """(node, component) for the lines that have similar lines, from staged (line, sim, size, place) of the distinct lines."""
    sims = distinct.select("line", "sim", "size").where("sim IS NOT NULL")
    take = take or choose_take(sims.count(), distance)
    pairs = dealt(sims, distance, take, split).mapInArrow(freed(_near_pairs(distance, similarity, crowd, take == 1)), PAIR)
    pairs = stage(pairs.distinct(), "pairs")
    links = stage(similar(documents, distinct, pairs.where("NOT crowded").select("a", "b"), similarity), "links")
    groups = stage(components(links, "a", "b"), "groups")
    crowded = sims.join(pairs.where("crowded").select(F.col("a").alias("line")).distinct(), "line")
    crowded = stage(crowded.join(groups.withColumnRenamed("node", "line"), "line", "left").select("line", "sim", "size", F.coalesce("component", "line").alias("group")), "crowded")
    if not crowded.limit(1).count():
        return groups
    more = dealt(crowded, distance, take, split).mapInArrow(freed(_far_pairs(distance, similarity, take == 1)), PAIR).select("a", "b").distinct()
    more = stage(more.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "more")
    if not more.limit(1).count():
        return groups
    return components(links.unionByName(similar(documents, distinct, more, similarity)), "a", "b")


def group_lines(documents: DataFrame, least: int = LEAST, short: bool = True, **options) -> DataFrame:
    """A row per line that isn't blank: doc_id, tie, line_no, first_doc_id, first_tie, first_line_no, kept.

    ``first_*`` tell the occurrence that stays of the line's group. A short line is of the group of its equals if ``short``, else its own.
    """
    found = stage(lines(documents, least, short), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie", "line_no")
    distinct = found.where("line IS NOT NULL").groupBy("line").agg(F.min(place).alias("place"), F.min("sim").alias("sim"), F.min("size").alias("size"))
    distinct = stage(distinct, "distinct")
    groups = line_groups(documents, distinct, **options)
    grouped = stage(distinct.select("line", "place").join(groups.withColumnRenamed("node", "line"), "line"), "grouped")
    firsts = grouped.groupBy("component").agg(F.min("place").alias("first"))
    firsts = stage(grouped.join(firsts, "component").select("line", "first"), "firsts")
    # A line without similar ones is a group by itself. Staged, so that Spark may split a line that is very common.
    labels = distinct.select("line", "place").join(firsts, "line", "left").select("line", F.coalesce("first", "place").alias("first"))
    labels = stage(labels, "labels")
    out = found.join(labels, "line", "left").withColumn("first", F.coalesce("first", place))
    kept = place.eqNullSafe(F.col("first"))
    return out.select(
        "doc_id", "tie", "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.tie").alias("first_tie"), F.col("first.line_no").alias("first_line_no"), kept.alias("kept")
    )


def dedup_lines(documents: DataFrame, least: int = LEAST, **options) -> DataFrame:
    """The documents without the lines that repeat others; the columns are those of ``documents``."""
    dropped = group_lines(documents, least, **options).where("NOT kept")
    dropped = stage(dropped.groupBy("doc_id", "tie").agg(F.collect_set("line_no").alias("dropped")), "dropped")
    doc, tie, gone, left = spare(documents.columns, "doc", "tie", "gone", "left")
    mine = dropped.select(F.col("doc_id").alias(doc), F.col("tie").alias(tie), F.col("dropped").alias(gone))
    same = documents["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(documents["text"].cast("string")) == F.col(tie))
    joined = documents.join(few(mine), same, "left")
    stays = F.filter(F.split("text", "\n", -1), lambda line, at: ~F.array_contains(gone, at))
    joined = joined.withColumn(left, F.when(F.col(gone).isNotNull(), F.array_join(stays, "\n")))
    joined = joined.where(F.col(left).isNull() | F.col(left).rlike(r"\S"))
    changed = {"text": F.coalesce(left, "text")}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.when(F.col(left).isNotNull(), F.length(left).cast("long")).otherwise(F.col("n_chars"))
    return joined.select(*(changed.get(name, F.col(f"`{name}`")).alias(name) for name in documents.columns))
