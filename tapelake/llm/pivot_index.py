"""Embedding near-duplicates through a pivot-permutation index.

1. Valid vectors (no null or non-finite component, not zero) with the same components form one class.
2. Pivots are chosen from a bounded sample of ``SAMPLE`` classes (those with the smallest hashes) by farthest-first traversal; their
   number follows the square root of the number of classes, between ``PIVOTS``. They are the only fitted part, at most
   ``PIVOTS[1]`` vectors, and go to the tasks with the job. Every class is described by its ``NEAREST`` nearest pivots in order.
3. Inverted lists: a class is entered once for each two of its pivots, so it meets on a list whom it shares at least two pivots
   with. Lists of more than ``SPLIT`` entries are cut into blocks that meet in pairs.
4. Members of a list are verified by their cosine in double precision. A pair that shares more pivots counts on the list of its two
   smallest common pivots alone. A list gives its members' numbers of links and a star for each local group, never its pairs.
5. Components of the stars, over classes.

Two vectors of cosine 0.95 share two of six pivots of 256 in more than 99 % of cases at 64 dimensions (higher cosines: more);
``tests/llm`` measures recall against all pairs.

Defined results: invalid vectors, and rows without vec_id, have no links and are their own component; vectors of different lengths
are never linked; repeated rows and equal vectors are linked with each other; of a class and its component the smallest vec_id counts.
Only the two columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import components, in_blocks, shuffle_partitions, sorted_runs
from tapelake.plans.staging import stage

COSINE = 0.95
NEAREST = 6
PIVOTS = (64, 2048)
SAMPLE = 8192
SPLIT = 4096
# Vectors described or compared at a time.
CHUNK = 1024


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged (vec_id, node) of all rows, node null for invalid ones, and (node, copies, least, vector) of the classes."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    valid = F.col("vec_id").isNotNull() & F.coalesce(fine & some, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(valid, F.transform(vector, lambda x: x + F.lit(0.0))).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    grouped = rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    return rows.select("vec_id", "node"), stage(grouped, "classes")


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that no square overflows or vanishes."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows that are far from each other: each next one has the smallest largest cosine to those before."""
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


def fit(grouped: DataFrame, sample: int = SAMPLE, bounds: tuple[int, int] = PIVOTS) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors that the sample has."""
    count = grouped.count()
    wanted = min(max(bounds[0], 2 ** round(math.log2(max(count, 1)) / 2)), bounds[1])
    rows = grouped.orderBy("node").limit(sample).select("vector").collect()
    lengths: dict[int, list] = {}
    for row in rows:
        lengths.setdefault(len(row["vector"]), []).append(row["vector"])
    return {length: choose_pivots(unit(np.array(held)), wanted) for length, held in lengths.items()}


ENTRY = "list long, node long, copies long, pivots binary, vector binary"


def _entries(pivots: dict[int, np.ndarray], nearest: int, small: bool):
    """A class's entries: one for each two of its nearest pivots. Lengths without pivots have one list each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(sizes):
                at = np.flatnonzero(sizes == length)
                known = pivots.get(int(length))
                for start in range(0, len(at), CHUNK):
                    part = batch.take(pa.array(at[start : start + CHUNK]))
                    matrix = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
                    k = min(nearest, 0 if known is None else len(known))
                    if k < 2:
                        order = np.zeros((len(matrix), 2), np.int64) + [0, 1]
                    else:
                        close = unit(matrix) @ known.T
                        order = np.argpartition(-close, k - 1, axis=1)[:, :k]
                        order = np.take_along_axis(order, np.argsort(-np.take_along_axis(close, order, axis=1), axis=1), axis=1)
                    members = np.sort(order, axis=1).astype(np.int32)
                    first, second = np.triu_indices(members.shape[1], 1)
                    lists = (np.int64(length) << 40) + (members[:, first].astype(np.int64) << 20) + members[:, second]
                    data = matrix.astype(np.float32 if small else np.float64)
                    rows_of = np.repeat(np.arange(len(matrix)), len(first))
                    yield pa.record_batch(
                        {
                            "list": pa.array(lists.ravel()),
                            "node": part.column("node").take(pa.array(rows_of)),
                            "copies": part.column("copies").take(pa.array(rows_of)),
                            "pivots": pa.array([row.tobytes() for row in members], pa.binary()).take(pa.array(rows_of)),
                            "vector": pa.array([row.tobytes() for row in data], pa.binary()).take(pa.array(rows_of)),
                        }
                    )

    return rows


def _stars(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels lowered until both ends of every pair agree."""
    while (labels[i] != labels[j]).any():
        least = np.minimum(labels[i], labels[j])
        np.minimum.at(labels, i, least)
        np.minimum.at(labels, j, least)
        labels = labels[labels]
    return labels


def _verify(cosine: float, small: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists, name, node, copies, side, pivots, vector in sorted_runs(batches, ("list", "name", "node", "copies", "side", "pivots", "vector")):
            cuts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
            out = []
            for a, b in zip(cuts, np.append(cuts[1:], len(lists)), strict=True):
                if b - a > 1:
                    out.append(_run(cosine, small, int(name[a]), node[a:b], copies[a:b], side[a:b], pivots[a:b], vector[a:b]))
            if out:
                node, star, n = (np.concatenate(part) for part in zip(*out, strict=True))
                for start in range(0, len(node), 100_000):
                    part = slice(start, start + 100_000)
                    yield pa.record_batch({"node": pa.array(node[part]), "star": pa.array(star[part]), "links": pa.array(n[part])})

    return rows


def _run(cosine: float, small: bool, name: int, node, copies, side, pivots, vector) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, star, links) of the members of one list that have links counted here."""
    matrix = unit(np.frombuffer(b"".join(vector), np.float32 if small else np.float64).reshape(len(node), -1).astype(np.float64))
    members = np.frombuffer(b"".join(pivots), np.int32).reshape(len(node), -1)
    mine = np.array([(name >> 20) & 0xFFFFF, name & 0xFFFFF])
    labels, links = np.arange(len(node)), np.zeros(len(node), np.int64)
    for start in range(0, len(node), CHUNK):
        i, j = np.nonzero(matrix[start : start + CHUNK] @ matrix.T >= cosine)
        i += start
        kept = (i < j) & ((side[i] < 0) | (side[i] != side[j]))
        i, j = i[kept], j[kept]
        for first in range(0, len(i), 1 << 16):
            x, y = i[first : first + (1 << 16)], j[first : first + (1 << 16)]
            common = (members[x][:, :, None] == members[y][:, None, :]).any(axis=2)
            # Members are in order, so the first two common ones name the list that counts the pair.
            rank = np.cumsum(common, axis=1) * common
            here = (members[x] * (rank == 1)).sum(axis=1) == mine[0]
            here &= (members[x] * (rank == 2)).sum(axis=1) == mine[1]
            x, y = x[here], y[here]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            labels = _stars(labels, x, y)
    found = np.flatnonzero(links)
    return node[found], node[labels[found]], links[found]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, split: int = SPLIT, pivots: dict[int, np.ndarray] | None = None) -> DataFrame:
    """A row per vector (vec_id, embedding): vec_id, n_links, component_id, kept."""
    small = "array<float>" in dict(vectors.dtypes)["embedding"]
    rows, grouped = classes(vectors)
    pivots = pivots or fit(grouped)
    entries = grouped.select("node", "copies", "vector").mapInArrow(_entries(pivots, nearest, small), ENTRY)
    entries = in_blocks(entries.withColumn("name", F.col("list")), "list", "node", split)
    dealt = entries.repartition(shuffle_partitions(vectors.sparkSession), "list").sortWithinPartitions("list")
    found = stage(dealt.mapInArrow(_verify(cosine, small), "node long, star long, links long"), "found")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found, "node", "star")
    known = grouped.select("node", "copies", "least").join(sums, "node", "left").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = stage(known, "known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(known, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
