"""Benchmark decontamination: test items inside documents, by size-partitioned MinHash containment search.

An item with q distinct shingles is contained in a document that has at least t = ceil(percent q / 100) of them. The item's sketch
is its q - t + 1 smallest shingle hashes: a document that lacks all of them has at most t - 1 of the item's shingles, so no
contained item is missed, however long the document is. (Sketches of a fixed length for both sides, compared by Jaccard
similarity, would miss a short item in a long document, whose similarity is close to 0.)

An item of fewer words than a shingle has is one shingle of its own length. The items of each such length are a partition by themselves,
for which a document has the shingles of that length, so the item is found wherever its words follow each other.

Items are partitioned by size. For each partition a document's sketch is its hashes up to the partition's largest sketch hash;
partitions whose items need more shingles than the document has are passed over. Items that share a sketch hash with a document
are candidates, verified by counting their shingles in the document's whole set.

The items are the stated query set: they go to the tasks in blocks of at most ``ITEM_BLOCK`` shingles (32 MB), one pass over the
documents each, whatever their number. Documents are never shuffled.

Defined results: null and empty texts, and items or documents without words, match nothing. Repeated items and rows each give their pairs,
with null ids where they have none. Further columns are passed through by ``decontaminate`` and ignored by ``contained_items``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import freed, small_batches
from tapelake.llm.shingles import WIDTH, as_bytes, distinct_shingles, roll, split_words, word_hashes
from tapelake.plans.staging import stage

PERCENT = 75
ITEM_BLOCK = 4_000_000


class Partition:
    """Items of one size class and shingle length: sketch hashes in order, the items of each, and the items' whole sets."""

    def __init__(self, width: int, items: list[tuple[int | None, np.ndarray]], percent: int) -> None:
        self.width = width
        self.ids = [item for item, _ in items]
        self.sets = [found for _, found in items]
        self.needs = [(percent * len(found) + 99) // 100 for found in self.sets]
        sketches = [found[: len(found) - need + 1] for found, need in zip(self.sets, self.needs, strict=True)]
        owner = np.repeat(np.arange(len(items)), [len(s) for s in sketches])
        hashes = np.concatenate(sketches)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owner[order]
        self.least = min(self.needs)

    def candidates(self, found: np.ndarray) -> np.ndarray:
        sketch = found[: np.searchsorted(found, self.hashes[-1], side="right")]
        low = np.searchsorted(self.hashes, sketch, side="left")
        high = np.searchsorted(self.hashes, sketch, side="right")
        return np.unique(np.concatenate([np.empty(0, np.int64), *(self.owners[a:b] for a, b in zip(low[high > low], high[high > low], strict=True))]))

    def contained(self, found: np.ndarray) -> Iterator[tuple[int | None, int, int]]:
        """(item, its shingles, those in ``found``) for every item contained in a document's sorted shingle set."""
        if len(found) < self.least:
            return
        for item in self.candidates(found):
            own = self.sets[item]
            at = np.minimum(np.searchsorted(found, own), len(found) - 1)
            shared = int((found[at] == own).sum())
            if shared >= self.needs[item]:
                yield self.ids[item], len(own), shared


def hits(text: bytes | None, partitions: list[Partition]) -> Iterator[tuple[int | None, int, int]]:
    """(item, its shingles, those in the text) for every item contained in it."""
    hashes = word_hashes(split_words(text))
    for width, some in groupby(partitions, key=lambda p: p.width):
        if len(hashes) >= width:
            found = np.unique(roll(hashes, width))
            for partition in some:
                yield from partition.contained(found)


def _item_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = [split_words(text) for text in as_bytes(batch.column("text"))]
            sets = [distinct_shingles(w, width) for w in words]
            yield pa.record_batch(
                {
                    "item_id": batch.column("item_id"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "width": pa.array([min(width, len(w)) for w in words], pa.int64()),
                    "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )

    return rows


Block = list[tuple[int, list[tuple[int | None, np.ndarray]]]]


def item_blocks(benchmark: DataFrame, width: int, limit: int) -> Iterator[Block]:
    """The benchmark in blocks of at most ``limit`` shingles, or of one item; a block is a list of items for each shingle length and
    size class."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    sets = stage(rows.mapInArrow(freed(_item_rows(width)), "item_id long, n long, width long, shingles binary").where("n > 0"), "items")
    held: dict[tuple[int, int], list] = {}
    load = 0
    for row in sets.orderBy("width", "n", "item_id").toLocalIterator():
        if load and load + row["n"] > limit:
            yield [(of, items) for (of, _), items in held.items()]
            held, load = {}, 0
        held.setdefault((row["width"], row["n"].bit_length()), []).append((row["item_id"], np.frombuffer(row["shingles"], np.uint64)))
        load += row["n"]
    if load:
        yield [(of, items) for (of, _), items in held.items()]


def _pairs(block, percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partitions = [Partition(width, items, percent) for width, items in block.value]
        for batch in small_batches(batches, "text"):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                out += [(doc, *hit) for hit in hits(text, partitions)]
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.record_batch({name: pa.array(values, pa.int64()) for name, values in zip(("doc_id", "item_id", "n_item", "n_shared"), columns, strict=True)})

    return rows


def contained_items(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT, limit: int = ITEM_BLOCK) -> DataFrame:
    """A row per document and item contained in it: doc_id, item_id, n_item, n_shared, containment."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_item long, n_shared long"
    found = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, width, limit):
        found = found.unionByName(rows.mapInArrow(freed(_pairs(spark.sparkContext.broadcast(block), percent)), schema))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def _clean(block, percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partitions = [Partition(width, items, percent) for width, items in block.value]
        for batch in small_batches(batches, "text"):
            keep = []
            for text in as_bytes(batch.column("text").cast(pa.large_string())):
                keep.append(next(hits(text, partitions), None) is None)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows


def decontaminate(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT, limit: int = ITEM_BLOCK) -> DataFrame:
    """The documents that contain no item, all columns as they are."""
    spark = documents.sparkSession
    for block in item_blocks(benchmark, width, limit):
        documents = documents.mapInArrow(freed(_clean(spark.sparkContext.broadcast(block), percent)), documents.schema)
    return documents
