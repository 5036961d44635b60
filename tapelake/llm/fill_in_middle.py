"""Fill-in-middle transformation by displacement scatter.

A text is cut into prefix, middle and suffix at two code points that follow from its id, and its parts are put in another order between
three marks, so that a model that reads from left to right learns to fill a gap. Whole batches are rearranged at once: a scan
over the bytes finds the cuts, a difference array holds where the distance to the place in the output changes, its cumulative sum
is the distance of every byte, and one numpy scatter writes the output. ``restore`` finds the marks and gathers the bytes back
by the inverse distances. Both work through a batch in blocks of ``BLOCK`` bytes, so a very long text costs its own size and the
output's, and nothing is shuffled.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, ``plain`` is the text as it is: an
empty one, one that holds a mark, and ``100 - RATE`` percent of all others.

Defined results: a null text is an empty one, a null id counts as an empty text in the hash; each of repeated rows gets the same output,
which follows from id and text alone; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import small_batches

SEED = 1
RATE = 90  # percent of the texts that are rearranged
SUFFIX_FIRST = 20  # percent of these with the suffix first
MARKS = ("<P>", "<S>", "<M>")
WIDTH = 3  # bytes of a mark
BLOCK = 1 << 20


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from an id: the first digits of a SHA-256 digest."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


# ---- batches as bytes ---------------------------------------------------------------------------------------------------
def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the place where each text starts, with the end of the last."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A text column from bytes."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _starts(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Block by block, which bytes start a code point."""
    for first in range(0, len(data), BLOCK):
        yield first, (data[first : first + BLOCK] & 0xC0) != 0x80


def code_points_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many code points start before each of the ascending places."""
    out, seen = np.zeros(len(places), np.int64), 0
    for first, starts in _starts(data):
        counts = np.cumsum(starts)
        low, high = np.searchsorted(places, [first + 1, first + len(starts) + 1])
        out[low:high] = seen + counts[places[low:high] - first - 1]
        seen += int(counts[-1])
    return out


def places_of(data: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Where the code points of ascending numbers start; the end for the number after the last."""
    out, seen = np.full(len(numbers), len(data), np.int64), 0
    for first, starts in _starts(data):
        here = np.flatnonzero(starts)
        low, high = np.searchsorted(numbers, [seen, seen + len(here)])
        out[low:high] = first + here[numbers[low:high] - seen]
        seen += len(here)
    return out


def _displaced(size: int, places: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Block by block, where the bytes go: ``shifts`` hold from the ascending ``places`` on, of several at a place the last one."""
    steps = np.diff(shifts, prepend=0)
    shift = 0
    for first in range(0, size, BLOCK):
        length = min(BLOCK, size - first)
        low, high = np.searchsorted(places, [first, first + length])
        change = np.zeros(length, np.int64)
        np.add.at(change, places[low:high] - first, steps[low:high])
        change[0] += shift
        moved = np.cumsum(change)
        shift = int(moved[-1])
        yield slice(first, first + length), moved + np.arange(first, first + length)


def _layout(prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where prefix, middle and suffix, and the marks P, S and M, start in the outputs; from the sizes of the parts."""
    plain, spm = form == "plain", form == "spm"
    at_prefix = np.where(plain, 0, np.where(spm, suffix + 2 * WIDTH, WIDTH))
    at_suffix = np.where(plain, prefix + middle, np.where(spm, WIDTH, prefix + 2 * WIDTH))
    at_middle = np.where(plain, prefix, prefix + suffix + 3 * WIDTH)
    parts = np.stack([at_prefix, at_middle, at_suffix], axis=1)
    marks = np.stack([at_prefix, at_suffix, at_middle], axis=1) - WIDTH
    return parts, marks


# ---- there --------------------------------------------------------------------------------------------------------------
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _rearranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        data, offsets = _bytes(batch.column("text"))
        form = np.array(batch.column("form").to_pylist(), object)
        first, second = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("h1", "h2"))
        before = code_points_before(data, offsets)
        n = np.diff(before)
        cuts = np.sort(np.stack([first % (n + 1), second % (n + 1)], axis=1), axis=1)
        places = places_of(data, (before[:-1, None] + cuts).ravel()).reshape(-1, 2)
        edges = np.concatenate([offsets[:-1, None], np.clip(places, offsets[:-1, None], offsets[1:, None]), offsets[1:, None]], axis=1)
        sizes = np.diff(edges, axis=1)
        parts, marks = _layout(*sizes.T, form)

        marked = form != "plain"
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets) + marked * len(MARKS) * WIDTH)])
        out = np.empty(ends[-1], np.uint8)
        shifts = ends[:-1, None] + parts - edges[:, :3]
        for block, to in _displaced(len(data), edges[:, :3].ravel(), shifts.ravel()):
            out[to] = data[block]
        for k, mark in enumerate(MARKS):
            at = (ends[:-1] + marks[:, k])[marked]
            out[at[:, None] + np.arange(WIDTH)] = np.frombuffer(mark.encode(), np.uint8)
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n": pa.array(n),
                "form": batch.column("form"),
                "prefix_chars": pa.array(cuts[:, 0], mask=~marked),
                "middle_chars": pa.array(cuts[:, 1] - cuts[:, 0], mask=~marked),
                "output": _texts(out, ends),
            }
        )


def transform(documents: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars and output of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    h1, h2, h3, h4 = draws(doc_id, seed)
    marked = F.lit(False)
    for mark in MARKS:
        marked |= text.contains(mark)
    plain = (text == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    rows = documents.select(doc_id.alias("doc_id"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    return rows.mapInArrow(_rearranged, OUTPUT)


# ---- and back -----------------------------------------------------------------------------------------------------------
def _marks_in(data: np.ndarray, letter: int) -> np.ndarray:
    """Where a mark with that letter stands, found block by block."""
    found = []
    for first in range(0, len(data), BLOCK):
        part = data[first : first + BLOCK + WIDTH - 1]
        found.append(first + np.flatnonzero((part[:-2] == ord("<")) & (part[1:-1] == letter) & (part[2:] == ord(">"))))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "output"):
        data, offsets = _bytes(batch.column("output"))
        form = np.array(batch.column("form").to_pylist(), object)
        marked = form != "plain"
        rows = np.flatnonzero(marked)
        at = np.zeros((len(form), len(MARKS)), np.int64)
        for k, mark in enumerate(MARKS):
            places = _marks_in(data, ord(mark[1]))
            # A rearranged text holds each mark once; plain ones may hold any.
            owner = np.searchsorted(offsets, places, side="right") - 1
            mine = marked[owner]
            if not np.array_equal(owner[mine], rows):
                raise ValueError(f"an output must hold {mark} exactly once")
            at[rows, k] = places[mine] - offsets[owner[mine]]
        size, spm = np.diff(offsets), form == "spm"
        p, s, m = at.T
        prefix = np.where(marked, np.where(spm, m, s) - p - WIDTH, size)
        suffix = np.where(marked, np.where(spm, p, m) - s - WIDTH, 0)
        middle = np.where(marked, size - m - WIDTH, 0)
        parts, _ = _layout(prefix, middle, suffix, form)

        sizes = np.stack([prefix, middle, suffix], axis=1)
        ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
        starts = ends[:-1, None] + np.cumsum(sizes, axis=1) - sizes
        shifts = offsets[:-1, None] + parts - starts
        text = np.empty(ends[-1], np.uint8)
        for block, place in _displaced(len(text), starts.ravel(), shifts.ravel()):
            text[block] = data[place]
        yield pa.RecordBatch.from_arrays([*batch.columns, _texts(text, ends)], [*batch.schema.names, "restored"])


def restore(outputs: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``restored``, the text rebuilt from output and form alone."""
    rows = outputs.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return rows.mapInArrow(_gathered, f"{OUTPUT}, restored string")


def digests(documents: DataFrame) -> DataFrame:
    """Forms and sizes with the digests of each output and of the text restored from it."""
    rows = restore(transform(documents))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )
