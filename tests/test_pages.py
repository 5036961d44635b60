"""Pages by position against a sorted list."""

import pytest
from pyspark.sql import functions as F

from tapelake.operators.pages import index_pages, open_pages


@pytest.fixture
def table(spark):
    return spark.range(2000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("skip,count", [(0, 5), (1, 1), (990, 700), (1999, 5), (2000, 5), (0, 5000), (17, 0)])
def test_pages(table, folder, skip, count):
    pages = index_pages(table, f"{folder}/p", "k", "v", slices=7)
    want = sorted((r.k, r.v) for r in table.collect())[skip : skip + count]
    got = pages.page(count, skip).collect()
    assert [(r.k, r.v) for r in got] == want
    assert [r.position for r in got] == list(range(skip, skip + len(want)))


def test_a_page_moves_its_rows_only(spark, table, folder):
    pages = open_pages(spark, index_pages(table, f"{folder}/p", "k", "v", slices=7).path, ["k", "v"])
    plan = pages.page(5, 1500)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "_place" in line]
    assert pushed and "_slice" in pushed[0] and "CollectLimit" not in plan


def test_one_slice_ties_and_nulls(spark, folder):
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (3, 4)], "k int, v int")
    pages = index_pages(rows, f"{folder}/p", "k", "v", slices=1)
    assert [r.v for r in pages.page(3, 1).collect()] == [2, 3, 4]
    assert len(pages) == 4


def test_empty_and_wrong(spark, folder):
    pages = index_pages(spark.createDataFrame([], "k int"), f"{folder}/p", "k")
    assert len(pages) == 0 and pages.page(5, 0).collect() == []
    with pytest.raises(ValueError):
        pages.page(-1)
    with pytest.raises(ValueError):
        index_pages(spark.range(1), f"{folder}/q")
    with pytest.raises(FileNotFoundError):
        open_pages(spark, f"{folder}/q", ["k"])
