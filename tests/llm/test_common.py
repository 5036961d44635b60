import random

import pyarrow as pa
import pytest
from helpers import Groups
from pyspark.sql import functions as F

from tapelake.llm.common import components, in_blocks, small_batches, sorted_runs, spare


@pytest.mark.parametrize("shape", ["random", "chain", "star", "empty"])
def test_components(spark, shape):
    draw = random.Random(5)
    edges = {
        "random": [(draw.randrange(300), draw.randrange(300)) for _ in range(200)],
        "chain": [(k, k + 1) for k in range(150)],
        "star": [(500, k) for k in range(200)],
        "empty": [],
    }[shape]
    rows = spark.createDataFrame(edges + [(7, 7)], "a long, b long").repartition(5)
    groups = Groups()
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    got = {r.node: r.component for r in components(rows, "a", "b").collect()}
    assert got == {node: groups.find(node) for node in groups.of}


def test_in_blocks_pairs_meet_once(spark):
    rows = spark.createDataFrame([(1, k) for k in range(50)] + [(2, k) for k in range(5)], "g long, m long")
    met = {}
    for r in in_blocks(rows, "g", "m", 8).groupBy("g").agg(F.collect_list(F.struct("m", "side")).alias("of")).collect():
        for x in r.of:
            for y in r.of:
                if x.m < y.m and (x.side < 0 or x.side != y.side):
                    met[(x.m, y.m)] = met.get((x.m, y.m), 0) + 1
    pairs = {(a, b): 1 for a in range(50) for b in range(a + 1, 50)}
    for a in range(5):
        for b in range(a + 1, 5):
            pairs[(a, b)] += 1
    assert met == pairs


def test_small_batches_and_runs():
    batch = pa.record_batch({"text": pa.array(["a" * 5, None, "", "b" * 50, "c"])})
    assert [b.num_rows for b in small_batches(iter([batch]), "text", 10)] == [3, 1, 1]
    assert list(small_batches(iter([batch.slice(0, 0)]), "text")) == []
    batches = [pa.record_batch({"k": pa.array(k, pa.int64()), "v": pa.array(k, pa.int64())}) for k in ([1, 1, 2], [], [2], [2, 2], [2, 3], [3])]
    runs = [[list(a) for a in run] for run in sorted_runs(iter(batches), ("k", "v"))]
    assert [run[0] for run in runs] == [[1, 1], [2, 2, 2, 2, 2], [3, 3]]


def test_spare():
    assert spare(["Doc", "_doc"], "doc", "x") == ["__doc", "x"]
