"""Source divergence audit: which sources of a language use its words unlike each other, and which words make the difference.

Terms are runs of letters: one ``bytes.translate`` lower-cases A to Z and blanks every other ASCII character, ``bytes.split`` cuts, and a
``Counter`` per document gives the counts of its terms and the documents they occur in. A task adds them up by (lang, source), ``HELD``
different ones at a time, so what is shuffled are counts, never words.

A language keeps its V terms that ``LEAST`` of its documents have. A group (lang, source), and the language itself, gives each of them
``p = 1 + floor(10**9 * (count + 1) / (N + V))``, N being its count of kept terms; ``f(p, q) = floor((p - q)**2 / q)``. Two answers:
``pair``, per ordered pair of sources the sum of f over all kept terms, and ``term``, per source the ``TOP`` terms that it uses more than
its language, by f against it.

The sum of a pair is sparse: a term that neither source has adds ``f(a, b)`` with their p for a count of 0. To V times this come, from
the number of terms per p of each source, what the terms of one side change, and from terms of both what these two sums miss. Only
the last part needs the sources of a term side by side; they are summed by pair within the task.

All arithmetic is exact: p from decimals, f and its differences in 64 bits (p is at most 10**9 + 1), sums in two halves.

The pair part has a row for each two sources of a language, as asked, so the sources of one language must be few enough for their
square. No row of the input is compared with another.

Defined results: null text, lang and source count as empty ones; repeated rows count each; a source without terms is a group; without
kept terms the pairs have the value 0 and no term is returned; an empty table gives no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import small_batches
from tapelake.plans.staging import stage

LEAST = 3
TOP = 200
SCALE = 1_000_000_000
HELD = 300_000  # terms of groups that a task counts at a time
PIECE = 1 << 20  # bytes of a text that are words at a time
PAIRS = 1 << 20  # pairs of sources of terms that a task holds at a time

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    plain = text.translate(_LETTERS)
    if len(plain) <= PIECE:
        return Counter(plain.split())
    counts: Counter = Counter()
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        counts.update(plain[start:end].split())
        start = end
    return counts


CELL = "lang string, source string, term string, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by (lang, source, term); a row with a null term tells that the group is there."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def cells() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in groups.items():
            terms, n = [None, *times], [0, *times.values()]
            in_docs = [0, *map(docs.__getitem__, times)]
            size = len(terms)
            yield pa.record_batch(
                {
                    "lang": pa.repeat(pa.scalar(lang, pa.string()), size),
                    "source": pa.repeat(pa.scalar(source, pa.string()), size),
                    "term": pa.array(terms, pa.binary()).cast(pa.string()),
                    "n": pa.array(n, pa.int64()),
                    "docs": pa.array(in_docs, pa.int64()),
                }
            )

    for batch in batches:
        for part in small_batches([batch], "text"):
            columns = (part.column(name).to_pylist() for name in ("lang", "source"))
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            for lang, source, text in zip(*columns, texts, strict=True):
                times, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                counts = term_counts(text)
                held -= len(times)
                times.update(counts)
                held += len(times)
                docs.update(counts.keys())
            if held > HELD:
                yield from cells()
                groups, held = {}, 0
    yield from cells()


def counted_terms(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, source, term, n, in_lang): counts of the terms that their language keeps, here and in the language; a row with a null term
    per group."""
    texts = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = texts.mapInArrow(_counted, CELL)
    # One shuffle serves both sums: they are by (lang, term, source) and by (lang, term).
    cells = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    cells = cells.withColumn("in_lang", F.sum("n").over(whole)).withColumn("docs", F.sum("docs").over(whole))
    return cells.where(F.col("term").isNull() | (F.col("docs") >= least)).select("lang", "source", "term", "n", "in_lang")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / (total + terms)), exactly; null without terms."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    below = (total + terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", above, below).cast("long") + 1)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def groups_of(cells: DataFrame) -> DataFrame:
    """Per (lang, source): its number within the language, total, the language's total and number of kept terms, and p of a count of 0."""
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = cells.where("term IS NOT NULL").groupBy("lang", "term").agg(F.first("in_lang").alias("n"))
    kept = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    totals = totals.join(kept, "lang", "left").na.fill(0, ["terms", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    return totals.withColumn("number", number).withColumn("zero", probability(F.lit(0), F.col("total"), F.col("terms")))


SHARED = "lang string, a int, b int, high long, low long"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What terms of two sources add to the sums of both pairs of them, by pair; from (lang, lists of number, p, zero)."""

    def f(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x - y) * (x - y) // y

    def sums(lang: str, number: np.ndarray, p: np.ndarray, zero: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        left, right = left[left != right], right[left != right]
        more = f(p[left], p[right]) - f(p[left], zero[right]) - f(zero[left], p[right]) + f(zero[left], zero[right])
        width = int(number.max(initial=0)) + 1
        pairs, at = np.unique(number[left] * width + number[right], return_inverse=True)
        high, low = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        np.add.at(high, at, more >> 32)
        np.add.at(low, at, more & 0xFFFFFFFF)
        return pa.record_batch(
            {
                "lang": pa.repeat(pa.scalar(lang, pa.string()), len(pairs)),
                "a": pa.array((pairs // width).astype(np.int32)),
                "b": pa.array((pairs % width).astype(np.int32)),
                "high": pa.array(high),
                "low": pa.array(low),
            }
        )

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        lists = batch.column("members")
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        start = 0
        while start < len(langs):
            end, held = start + 1, sizes[start] ** 2
            while end < len(langs) and langs[end] == langs[start] and held + sizes[end] ** 2 <= PAIRS:
                held += sizes[end] ** 2
                end += 1
            members, size = lists.slice(start, end - start).flatten(), sizes[start:end]
            columns = [members.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)]
            first = np.repeat(np.cumsum(size) - size, size)  # where the term of each member starts
            width = np.repeat(size, size)  # and how many members it has
            rows = len(width) if held <= PAIRS else max(1, PAIRS // len(width))  # a single term may have too many pairs
            for low in range(0, len(width), rows):
                high = min(low + rows, len(width))
                left = np.repeat(np.arange(low, high), width[low:high])
                within = np.arange(len(left)) - np.repeat(np.cumsum(width[low:high]) - width[low:high], width[low:high])
                yield sums(langs[start], *columns, left, first[left] + within)
            start = end


def pair_divergences(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each source and each other one of its language."""
    wide = "decimal(38,0)"
    mine = groups.select("lang", F.col("number").alias("a"), F.col("source"), F.col("zero").alias("za"), "terms")
    other = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("zero").alias("zb"))
    pairs = mine.join(other, "lang").where("a <> b")
    none = F.coalesce(F.col("terms").cast(wide) * divergence(F.col("za"), F.col("zb")).cast(wide), F.lit(0).cast(wide))
    base = pairs.select("lang", "a", "b", none.alias("value"))

    counts = cells.where("n > 0").groupBy("lang", "number", "p", "zero").agg(F.count("*").alias("terms"))
    to = groups.select("lang", F.col("number").alias("to"), F.col("zero").alias("z"))
    one = counts.join(to, "lang").where("number <> to")
    p, zero, z = F.col("p"), F.col("zero"), F.col("z")

    def part(a: str, b: str, value: Column) -> DataFrame:
        return one.select("lang", F.col(a).alias("a"), F.col(b).alias("b"), (F.col("terms").cast("decimal(18,0)") * value.cast("decimal(19,0)")).cast(wide).alias("value"))

    mine_only = part("number", "to", divergence(p, z) - divergence(zero, z))
    other_only = part("to", "number", divergence(z, p) - divergence(z, zero))

    members = cells.where("n > 0").groupBy("lang", "term").agg(F.collect_list(F.struct("number", "p", "zero")).alias("members"))
    both = members.where(F.size("members") > 1).select("lang", "members").mapInArrow(_shared, SHARED)
    both = both.groupBy("lang", "a", "b").agg(F.sum(F.col("high").cast("decimal(20,0)")).alias("high"), F.sum(F.col("low").cast("decimal(20,0)")).alias("low"))
    both = both.select("lang", "a", "b", (F.col("high").cast("decimal(24,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("low")).cast(wide).alias("value"))

    parts = base.unionByName(mine_only).unionByName(other_only).unionByName(both)
    found = parts.groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))
    return pairs.select("lang", "a", "b", "source", "item").join(found, ["lang", "a", "b"]).select("lang", "source", "item", "value")


def audit(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank (from 1 per group and part)."""
    cells = stage(counted_terms(documents, least), "terms")
    groups = stage(groups_of(cells), "groups")
    known = groups.select("lang", "source", "number", "total", "terms", "lang_total", "zero")
    cells = cells.where("term IS NOT NULL").join(known, ["lang", "source"])
    cells = cells.withColumn("p", probability(F.col("n"), F.col("total"), F.col("terms")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    pairs = pair_divergences(cells, groups)
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))

    q = probability(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    terms = cells.where("n > 0").withColumn("q", q).where("p > q")
    terms = terms.select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
