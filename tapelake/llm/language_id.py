"""Language identification by rank-order profiles of character n-grams.

Words are runs of letters in lower case, with a blank on both sides; their n-grams of 1 to ``LONGEST`` characters are counted over a
text. The profile of a language is its ``PROFILE`` most frequent n-grams in order, from all documents to learn from; that of a
document likewise. The out-of-place distance sums, over the document's n-grams, by how many ranks they are displaced in the profile of
the language, ``PROFILE`` for one that isn't there. The language with the least distance is the answer, of equally near ones the first
by name; the score is 1 - distance / the largest possible one. Of equally frequent n-grams the first by code points ranks first.

Counting goes by whole batches: lower-cased texts become arrays of code points, an n-gram the digits of a number over the batch's
alphabet, and one sort of (text, n-gram) numbers gives all counts, equally frequent ones in order. A task adds up the n-grams of the
documents it learns from, so counts alone are shuffled; the driver and the tasks hold the profiles, ``PROFILE`` short strings a
language. Texts are scored where they are read; a long text is counted in pieces of ``PIECE`` characters.

Learning uses documents with ``crc32(doc_id as text) % 4 <> 2`` and a language, all of them; text and language alone.

Defined results: a text that is null or has no letter (Unicode category L) is ``und`` with score 0, as are all texts if nothing was
learned; a null id is neither held out (null) nor learned from; repeated rows are learned from as often as they stand and scored alike;
an empty language is a language; an empty table gives no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import small_batches

LONGEST = 3
PROFILE = 400
HELD_OUT = 2
UNKNOWN = "und"
PIECE = 1 << 20  # characters that are n-grams at a time
GRAMS = 400_000  # n-grams that a task counts at a time
LARGEST = 1 << 62
ROWS = 1024  # texts at a time; with all letters there are as digits, rows and n-grams make numbers below 2**63


# ---- counting -----------------------------------------------------------------------------------------------------------
@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """(row, part of its text), at most about ``PIECE`` characters at a time; texts are cut after blanks."""
    held, size = [], 0
    for row, text in enumerate(texts):
        start = 0
        while text and start < len(text):
            end = min(start + PIECE, len(text))
            while end < len(text) and not text[end - 1].isspace():
                end += 1
            if held and size + end - start > PIECE:
                yield held
                held, size = [], 0
            held.append((row, text[start:end]))
            size += end - start
            start = end
    if held:
        yield held


def _points(piece: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased code points of the letters, and of a blank (0) before and after each word; and their rows."""
    low = [text.lower() for _, text in piece]
    points = np.frombuffer(" ".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    rows = np.repeat(np.array([0, *(row for row, _ in piece)]), [1, *(len(text) + 1 for text in low)])
    return np.where(letter, points, 0)[kept], rows[kept]


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram, count) in order of row and n-gram, and the alphabet whose digits, from 1, n-grams are written in.

    An n-gram has ``LONGEST`` digits, the first of its characters the highest, 0 for none; so numbers are ordered like the strings.
    """
    pieces = list(_pieces(texts))
    single = [_points(piece) for piece in pieces] if len(pieces) == 1 else None
    seen = np.zeros(0x110000, bool)
    for piece in single or map(_points, pieces):
        seen[piece[0]] = True
    seen[0] = True
    alphabet = np.flatnonzero(seen)  # the blank first
    base = len(alphabet) + 1
    digit = np.zeros(0x110000, np.int64)
    digit[alphabet] = np.arange(1, base)
    whole = base**LONGEST
    found = []
    for points, rows in single or map(_points, pieces):
        blank, digits = points == 0, digit[points]
        rows = np.where(blank, np.append(rows[1:], 0), rows) * whole  # a blank belongs to the word after it
        keys = []
        for n in range(1, LONGEST + 1):
            if len(points) < n:
                break
            # No blank inside, and a blank alone is no n-gram.
            last = len(points) - n + 1
            inner = np.zeros(last, bool)
            for k in range(1, n - 1):
                inner |= blank[k : k + last]
            fits = np.flatnonzero(~inner & ~blank[:last] if n == 1 else ~inner)
            key = (rows[:last] if n == 1 else np.where(blank[:last], rows[1 : last + 1], rows[:last]))[fits]
            for k in range(n):
                key += digits[fits + k] * base ** (LONGEST - 1 - k)
            keys.append(key)
        key = np.sort(np.concatenate(keys))
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        found.append((key[starts], np.diff(starts, append=len(key))))
    if not found:
        return (np.zeros(0, np.int64),) * 3 + (alphabet,)
    keys, counts = (np.concatenate(column) for column in zip(*found, strict=True))
    if len(found) > 1:
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
        keys, counts = keys[order][starts], np.add.reduceat(counts[order], starts)
    return keys // whole, keys % whole, counts, alphabet


def spelled(grams: np.ndarray, alphabet: np.ndarray) -> list[str]:
    """N-grams as strings."""
    base = len(alphabet) + 1
    points = np.append(0, np.where(alphabet == 0, ord(" "), alphabet))  # digit 0: no character
    digits = np.stack([grams // base ** (LONGEST - 1 - k) % base for k in range(LONGEST)], axis=1)
    return points[digits].astype(np.uint32).view(f"<U{LONGEST}").ravel().tolist()


def numbers(grams: list[str], alphabet: np.ndarray) -> np.ndarray:
    """Strings as n-grams over an alphabet; -1 for those with other characters."""
    base = len(alphabet) + 1
    points = np.array(grams, f"<U{LONGEST}").view(np.uint32).reshape(-1, LONGEST)
    points = np.where(points == ord(" "), 0, np.where(points == 0, -1, points.astype(np.int64)))
    at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
    digits = np.where(points < 0, 0, at + 1)
    known = (points < 0) | (alphabet[at] == points)
    value = sum(digits[:, k] * base ** (LONGEST - 1 - k) for k in range(LONGEST))
    return np.where(known.all(axis=1), value, -1)


# ---- learning -----------------------------------------------------------------------------------------------------------
def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language."""
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.record_batch(
                {
                    "lang": pa.repeat(pa.scalar(lang, pa.string()), len(counts)),
                    "gram": pa.array(list(counts), pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                }
            )
        held.clear()

    for batch in small_batches(batches, "text"):
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for lang in set(langs):
            mine = [text for text, of in zip(texts, langs, strict=True) if of == lang]
            _, grams, counts, alphabet = gram_counts(["\n".join(mine)])
            into = held.setdefault(lang, Counter())
            for gram, n in zip(spelled(grams, alphabet), counts.tolist(), strict=True):
                into[gram] += n
        if sum(map(len, held.values())) > GRAMS:
            yield from out()
    yield from out()


def learn(documents: DataFrame, size: int = PROFILE) -> dict[str, list[str]]:
    """The profile of each language: its most frequent n-grams in order."""
    doc_id = F.col("doc_id").cast("long")
    rows = documents.where((remainder(doc_id) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "gram", "rank")
    profiles: dict[str, list[str]] = {}
    for row in sorted(top.collect(), key=lambda r: (r.lang, r.rank)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


# ---- scoring ------------------------------------------------------------------------------------------------------------
def ranked(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram, rank) of the most frequent n-grams of each text, and their alphabet."""
    row, gram, counts, alphabet = gram_counts(texts)
    most, whole = int(counts.max(initial=0)), (len(alphabet) + 1) ** LONGEST
    if len(texts) * (most + 1) * whole < LARGEST:
        key = np.sort((row * (most + 1) + (most - counts)) * whole + gram)
        row, gram = key // whole // (most + 1), key % whole
    else:
        order = np.lexsort((-counts, row))  # stable: equal counts stay in order
        row, gram = row[order], gram[order]
    rank = np.arange(len(row)) - np.searchsorted(row, np.arange(len(texts)))[row]
    kept = rank < size
    return row[kept], gram[kept], rank[kept], alphabet


def nearest(texts: list[str | None], profiles: dict[str, list[str]], size: int) -> tuple[list[str], np.ndarray]:
    """The language and score of each text."""
    row, gram, rank, alphabet = ranked(texts, size)
    grams = np.bincount(row, minlength=len(texts))
    names = sorted(profiles)
    best, answer = np.full(len(texts), np.iinfo(np.int64).max), np.full(len(texts), -1)
    for k, name in enumerate(names):
        known = numbers(profiles[name], alphabet)
        order = np.argsort(known)
        at = np.minimum(np.searchsorted(known, gram, sorter=order), len(known) - 1)
        place = order[at]
        off = np.where(known[place] == gram, np.abs(place - rank), size)
        distance = np.bincount(row, weights=off, minlength=len(texts)).astype(np.int64)
        nearer = (grams > 0) & (distance < best)
        best[nearer], answer[nearer] = distance[nearer], k
    score = np.where(answer >= 0, 1 - best / np.maximum(grams * size, 1), 0.0)
    return [names[k] if k >= 0 else UNKNOWN for k in answer], score


def _identified(profiles: dict[str, list[str]], size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            for part in (batch.slice(first, ROWS) for first in range(0, batch.num_rows, ROWS)):
                langs, score = nearest(part.column("text").to_pylist(), profiles, size)
                yield pa.record_batch(
                    {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(score)}
                )

    return rows


def identify(documents: DataFrame, profiles: dict[str, list[str]], size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    doc_id = F.col("doc_id").cast("long")
    rows = documents.select(doc_id.alias("doc_id"), (remainder(doc_id) == HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_identified(profiles, size), "doc_id long, held_out boolean, lang_pred string, score double")
