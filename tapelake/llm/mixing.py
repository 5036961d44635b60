"""Mixing sources to target weights, in blocks of a fixed number of words.

The words of a source, its documents one after the other in a pseudorandom order, are packed into blocks of ``block`` words; the
last block may be shorter. A source's target is met by passes over all its blocks and a last pass over some of them, whose last
block may be cut, so that the words taken are the rounded target exactly. A *slot* is one block taken.

1. Sizes of documents and sources; targets by weight, held at ``most`` times a source's size, the excess shared anew by weight.
2. Each source's slots are dealt to output shards by a multinomial draw, one count per shard, seeded by the source's name.
3. Slots are numbered through the shards; a keyed pseudorandom permutation of each pass maps slot numbers to block numbers.
4. Blocks are joined to slots by source and number.

Positions inside a source come from sums over hashed chunks of its documents and a running sum within each chunk, so no task
gets a whole source, and the blocks and slots of one source spread over all tasks. Only the table of sources (a row for each) is
ordered as a whole.

Defined results: a null text has size 0; a null source is a source of its own, the last in order; documents of size 0 and empty
tables give taken 0 or no rows; each repeated row is a document of its own, also with a null doc_id. Every draw depends only on the
rows and ``seed``, so reruns agree. Only the three columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapelake.llm.common import freed, shuffle_partitions
from tapelake.plans.staging import stage

BLOCK = 256
MOST = 3
WEIGHTS = (1, 2, 3)
SHARD_SLOTS = 4096
TASK_SLOTS = 1 << 17  # slots that a task makes
WORD = r"[^\x20\x09-\x0D]+"


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and a number that orders rows with one doc_id."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), F.xxhash64(text).alias("tie"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_no, source_size, target.

    Sorted by what they may hold per unit of weight, the sources that are held at their limit come first; what they leave is
    shared by the others.
    """
    named = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = named.withColumn("source_no", number).withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wide = "decimal(38,0)"
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(by_room), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_room), F.lit(0))
    rows = rows.withColumns({"rest": rest, "open_weight": open_weight})
    rows = rows.withColumn("held", F.col("cap").cast(wide) * F.col("open_weight") <= F.col("rest").cast(wide) * F.col("weight"))
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum(F.when(F.col("held"), F.col("cap"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("held"), F.col("weight"))).over(whole)
    share = rest.cast("double") * F.col("weight") / open_weight
    return rows.select("source", "source_no", "source_size", F.when(F.col("held"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def planned(sources: DataFrame, block: int) -> DataFrame:
    """Per source: ``full`` whole blocks and ``tail`` words after them; ``passes`` over all, then ``last`` blocks, then ``cut`` words."""
    size, words = F.col("source_size"), F.round("target").cast("long")
    rows = sources.withColumns({"full": F.expr(f"source_size div {block}"), "tail": size % block, "passes": F.when(size > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)})
    rows = rows.withColumn("rest", words - F.col("passes") * size)
    rows = rows.withColumns({"last": F.expr(f"rest div {block}"), "cut": F.col("rest") % block})
    slots = F.col("passes") * (F.col("full") + (F.col("tail") > 0).cast("long")) + F.col("last") + (F.col("cut") > 0).cast("long")
    return rows.withColumn("slots", slots)


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """sized with source_no and ``start``, the number of words before a document in its source."""
    count = sized.agg(F.count("*")).first()[0]
    chunks = max(1, math.isqrt(count))  # as many as documents in one, so neither sum grows with the table
    rows = sized.join(sources.select("source", "source_no"), sized.source.eqNullSafe(sources.source)).drop(sources.source)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(chunks)))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source_no", "chunk").agg(F.sum("size").alias("words")).withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    inside = Window.partitionBy("source_no", "chunk").orderBy("doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(sums.select("source_no", "chunk", "base"), ["source_no", "chunk"]).withColumn("start", F.col("base") + F.col("within")).drop("base", "within", "chunk", "tie")


def permuted(index: np.ndarray, count: int, key: int) -> np.ndarray:
    """Images of ``index`` under a keyed permutation of 0..count-1: a Feistel network over the next power of four, walked until
    the image is below ``count``."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & mask
        for turn in range(4):
            turn_key = np.uint64((key + turn * 0xD6E8FEB86659FD93) % (1 << 64))
            f = (right + turn_key) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, (left ^ f) & mask
        x = (left << shift) | right
        out[todo] = x
        todo = todo[x >= np.uint64(count)]
    return out.astype(np.int64)


def _draw_key(seed: int, source: str | None, number: int) -> int:
    name = b"\x00" if source is None else b"\x01" + source.encode()
    return xxhash.xxh64_intdigest(b"%d/%d/" % (seed, number) + name)


def _draws(shards: int, seed: int):
    """Multinomial counts of a source's slots over the shards: (source_no, shard, first, count)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                random = np.random.Generator(np.random.Philox(key=_draw_key(seed, row["source"], -1)))
                counts = random.multinomial(row["slots"], np.full(shards, 1 / shards))
                first = np.cumsum(counts) - counts
                for start in range(0, shards, 10_000):
                    part = slice(start, start + 10_000)
                    number = pa.array(np.arange(shards)[part])
                    yield pa.record_batch({"source_no": pa.array([row["source_no"]] * len(number), pa.int32()), "shard": number, "first": pa.array(first[part]), "count": pa.array(counts[part])})

    return rows


def _slots(block: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for first in range(row["first"], row["first"] + row["count"], 100_000):
                    slot = np.arange(first, min(first + 100_000, row["first"] + row["count"]))
                    in_pass = row["full"] + (row["tail"] > 0)
                    number, place = np.divmod(slot, max(in_pass, 1))
                    index = np.full(len(slot), row["full"], np.int64)  # the short block ends a pass
                    for one in np.unique(number):
                        at = (number == one) & (place < row["full"])
                        index[at] = permuted(place[at], row["full"], _draw_key(seed, row["source"], int(one)))
                    words = np.where(place < row["full"], block, row["tail"])
                    cut = (number == row["passes"]) & (place == row["last"])
                    words = np.where(cut, row["cut"], words)
                    yield pa.record_batch(
                        {
                            "source_no": pa.array([row["source_no"]] * len(slot), pa.int32()),
                            "shard": pa.array([row["shard"]] * len(slot), pa.int64()),
                            "slot": pa.array(slot),
                            "block": pa.array(index),
                            "words": pa.array(words),
                        }
                    )

    return rows


def drawn(plan: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """The mix: source_no, shard, slot, block, words (of the block, from its start)."""
    total = plan.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_slots))
    counts = plan.select("source", "source_no", "slots").mapInArrow(freed(_draws(shards, seed)), "source_no int, shard long, first long, count long").where("count > 0")
    rows = counts.join(plan.select("source", "source_no", "full", "tail", "passes", "last", "cut"), "source_no")
    # A few draws are many slots: deal them out over a number of tasks that adaptive execution leaves as it is.
    tasks = max(shuffle_partitions(plan.sparkSession), math.ceil(total / TASK_SLOTS))
    rows = rows.repartition(tasks, "source_no", "shard")
    return rows.mapInArrow(freed(_slots(block, seed)), "source_no int, shard long, slot long, block long, words long")


def pieces(located: DataFrame, block: int) -> DataFrame:
    """Where documents and blocks overlap: source_no, block, doc_id, size, start, low, high (words of the block)."""
    last = F.expr(f"(start + size - 1) div {block}")
    rows = located.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), last)))
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    return rows.withColumns({"low": low, "high": high})


def mix(documents: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 1) -> DataFrame:
    """A row per document (doc_id, text, source): doc_id, size, source_size, target, taken (words of it in the mix)."""
    sized = stage(sizes(documents), "sizes")
    plan = stage(planned(targets(sized, weights, most), block), "plan")
    located = placed(sized, plan)
    slots = drawn(plan, block, shard_slots, seed)
    whole = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    used = slots.join(plan.select("source_no", "source_size"), "source_no").withColumn("cut", F.col("words") < whole)
    used = used.groupBy("source_no", "block").agg(F.sum((~F.col("cut")).cast("long")).alias("times"), F.max(F.when(F.col("cut"), F.col("words"))).alias("cut"))
    joined = pieces(located, block).join(used, ["source_no", "block"], "left")
    partly = F.greatest(F.least("high", "cut") - F.col("low"), F.lit(0))
    taken = F.coalesce(F.col("times") * (F.col("high") - F.col("low")), F.lit(0)) + F.when(F.col("cut").isNotNull(), partly).otherwise(0)
    counted = joined.groupBy("source_no", "start", "doc_id", "size").agg(F.sum(taken).alias("taken")).drop("start")
    empty = located.where("size = 0").select("source_no", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    out = counted.unionByName(empty).join(plan.select("source_no", "source_size", "target"), "source_no")
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mixed_texts(documents: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 1) -> DataFrame:
    """The mix itself: shard, slot, place (order inside the block), source, doc_id, text.

    A block's text is its rows in the order of ``place``, their words separated by spaces.
    """
    kept = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    sized = stage(sizes(documents), "sizes")
    plan = stage(planned(targets(sized, weights, most), block), "plan")
    # One copy of repeated rows serves them all.
    texts = kept.withColumn("tie", F.xxhash64("text")).dropDuplicates(["doc_id", "source", "tie"])
    located = placed(sized.withColumn("name", F.col("source")).withColumn("mark", F.col("tie")), plan)
    parts = pieces(located, block).join(drawn(plan, block, shard_slots, seed), ["source_no", "block"]).withColumn("high", F.least("high", "words")).where("high > low")
    same = parts.doc_id.eqNullSafe(texts.doc_id) & parts.name.eqNullSafe(texts.source) & (parts.mark == texts.tie)
    skipped = F.col("block") * block + F.col("low") - F.col("start")
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (skipped + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    return parts.join(texts, same).select("shard", F.col("source_no"), "slot", F.col("low").alias("place"), parts.name.alias("source"), parts.doc_id, F.array_join(words, " ").alias("text"))
