"""Helpers shared by the operators: reading, batches of bounded size, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.plans.staging import stage

Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# Characters of text that a Python worker holds as separate words at a time; a longer single text makes a batch of its own.
BATCH_CHARS = 1 << 20


# What Spark hands to a Python worker at a time; a task holds such a batch in the JVM and in Python.
ARROW_BYTES = "8m"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches that tasks exchange with Python (Spark's default is 64 MB)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables, for jobs with bounded batches."""
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the values of a text or binary ``column`` sum to ``limit`` bytes or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, length in enumerate(sizes):
            if row > start and held + length > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        yield batch.slice(start)


def freed(rows: Rows) -> Rows:
    """The same function of Arrow batches, after which its worker gives unused memory back to the system.

    Workers are used again for later stages; without this each keeps the most that any of its tasks held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:  # the GNU C library's
                trim(0)

    return run


# Keys of a join side that may be broadcast once they are counted: 16 MB of longs.
FEW_KEYS = 1_000_000


def few(keys: DataFrame) -> DataFrame:
    """``keys`` (staged), marked for broadcasting if there are at most ``FEW_KEYS``; beyond that Spark shuffles both sides."""
    return F.broadcast(keys) if keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS else keys


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spare(taken: list[str], *names: str) -> list[str]:
    """Column names like the given ones that none of ``taken`` equals."""
    lower = {name.lower() for name in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name = "_" + name
        out.append(name)
    return out


class Forest:
    """Union-find over the nodes of one task; the root of a tree is its smallest node."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, node):
        parent = self.parent
        top = parent.setdefault(node, node)
        while parent[top] != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    def join(self, a, b) -> bool:
        """Unite two trees; False if they were one already."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def in_blocks(rows: DataFrame, group: str, member: str, limit: int) -> DataFrame:
    """Split large groups whose members are to be compared in pairs.

    Adds ``side``. Groups (a long) of at most ``limit`` rows stay as they are, with side -1. Those of a larger group are cut into blocks
    by the hash of ``member``; a block makes a group by itself (side -1), and so does each pair of blocks (sides 0 and 1), where
    only members of different sides are to be compared. So any two members meet once, and no task gets a whole large group.
    """
    large = stage(rows.groupBy(group).agg(F.count("*").alias("size")).where(F.col("size") > limit), "large")
    if not large.limit(1).count():
        return rows.withColumn("side", F.lit(-1))
    large = large.select(group, F.ceil(F.col("size") / F.lit(limit)).cast("int").alias("blocks"))
    rows = rows.join(large, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")

    def route(k):
        name = F.xxhash64(F.col(group), F.least(k, F.col("own")), F.greatest(k, F.col("own")))
        return F.struct(name.alias("name"), F.when(k == F.col("own"), -1).when(k > F.col("own"), 0).otherwise(1).alias("side"))

    routes = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), route)
    rows = rows.withColumn("own", own).withColumn("route", F.explode(routes)).drop(group)
    return rows.withColumn(group, F.col("route.name")).withColumn("side", F.col("route.side")).drop("route", "own", "blocks")


def sorted_runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of equal values of the first one, several runs at a time, from rows sorted by it."""
    held: list[list[np.ndarray]] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
        last = new[0][-1]
        cut = np.searchsorted(new[0], last, side="left")
        if held is None:
            held = [[a] for a in new]
        else:
            for parts, a in zip(held, new, strict=True):
                parts.append(a)
        if cut or held[0][0][0] != last:
            whole = [np.concatenate(parts) for parts in held]
            cut = np.searchsorted(whole[0], last, side="left")
            yield [a[:cut] for a in whole]
            held = [[a[cut:]] for a in whole]
    if held is not None:
        yield [np.concatenate(parts) for parts in held]


# Nodes that a task contracts at a time.
FOREST_NODES = 1 << 18


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task, some at a time, by (node, smallest node of its local tree)."""
    forest = Forest()

    def stars() -> pa.RecordBatch:
        found = [(node, forest.root(node)) for node in list(forest.parent)]
        found = [(a, b) for a, b in found if a != b]
        return pa.record_batch({"u": pa.array([a for a, _ in found], pa.int64()), "v": pa.array([b for _, b in found], pa.int64())})

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.parent) > FOREST_NODES:
            yield stars()
            forest = Forest()
    yield stars()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components of an undirected graph: (node, component), for every node that has an edge.

    ``component`` is the smallest node that can be reached. Edges are first contracted within each task, then by rounds of
    large and small stars, each a minimum per node and a join; every round is written to the shared folder, so lost executors
    cost one round. Hot nodes are pre-aggregated and their joins are left to adaptive skew splitting. The driver sees one
    count per round.
    """
    pairs = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
    pairs = pairs.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    pairs = stage(pairs.mapInArrow(freed(_local_stars), "u long, v long"), "edges")  # u > v
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        after = stage(small.distinct(), "edges")
        if settled(after):
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        pairs = after


def settled(pairs: DataFrame) -> bool:
    """Is every edge (u, v) a node and its root: one v per u, and no v that is also a u?"""
    roots = pairs.select(F.col("v").alias("u")).distinct()
    if pairs.join(roots, "u", "left_semi").limit(1).count():
        return False
    return not pairs.groupBy("u").count().where("count > 1").limit(1).count()
