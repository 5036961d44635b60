"""Row numbers within groups, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.plans.staging import stage

# A group up to this many rows is numbered by a plain window, that is by one task.
GROUP_ROWS = 5_000_000
# Copies of one row are expanded in blocks of this many.
COPY_BLOCK = 100_000


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "update_seq",
    start: int = 1,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``row_number() over (partition by group order by order)``, counted from ``start``.

    ``group`` columns must not be null. ``order`` should tell rows apart unless they are equal in every column, else the
    numbers of tied rows are arbitrary. One aggregation finds groups above ``group_rows``; those are numbered in slices,
    see ``_number_large``. Both ways give the same numbers.
    """
    group, order = list(group), list(order)
    large = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > group_rows)
    total = large.agg(F.sum("_rows")).first()[0]
    if not total:
        return _number_plain(df, group, order, name, start)
    keys = stage(large.select(*group), "large-groups")
    small_part = _number_plain(df.join(keys, group, "left_anti").select(*df.columns), group, order, name, start)
    large_part = _number_large(
        df.join(keys, group, "left_semi").select(*df.columns), group, order, name, start, -(-total // group_rows)
    )
    return small_part.unionByName(large_part)


def number_consecutive(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    name: str = "update_seq",
    start: int = 1,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``number_rows`` by one column of whole numbers that differ within each group.

    Where they have no gap, as the lines of a file that one task read have none, a row's number is its distance from the first of the
    group: one aggregation with a row per group, and no row is shuffled. Groups with gaps are numbered by ``number_rows``.
    """
    group, columns = list(group), df.columns
    spans = df.groupBy(*group).agg(F.min(order).alias("_first"), (F.max(order) - F.min(order) + 1 == F.count(F.lit(1))).alias("_whole"))
    spans = stage(spans, "spans")
    whole = df.join(spans.filter("_whole").drop("_whole"), group)
    whole = whole.select(*columns, (F.col(order) - F.col("_first") + start).cast("bigint").alias(name))
    gaps = spans.filter("NOT _whole").select(*group)
    if gaps.isEmpty():
        return whole
    rest = df.join(gaps, group, "left_semi").select(*columns)
    return whole.unionByName(number_rows(rest, group, [order], name, start, group_rows))


def _number_plain(df: DataFrame, group: list[str], order: list[str], name: str, start: int) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint")
    return df.withColumn(name, number + (start - 1))


def _number_large(df: DataFrame, group: list[str], order: list[str], name: str, start: int, slices: int) -> DataFrame:
    """Number groups by slices of a range partitioning.

    Copies of one row collapse to a row with a count before anything is shuffled. The distinct rows are range-partitioned on
    (group, order) and written out, which fixes the slices for every later use. The rows before each slice of a group are
    a running total over a table with one row per slice and group. Copies are expanded again in blocks.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    sliced = stage(
        counted.repartitionByRange(max(2, 2 * slices), *group, *order).withColumn("_slice", F.spark_partition_id()),
        "numbering",
    )
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slice_start = (
        sliced.groupBy(*group, "_slice")
        .agg(F.sum("_copies").alias("_slice_rows"))
        .select(*group, "_slice", F.coalesce(F.sum("_slice_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sliced.join(slice_start, [*group, "_slice"])
        .withColumn("_first", F.col("_before") + F.coalesce(F.sum("_copies").over(within), F.lit(0)) + start)
        .select(*columns, "_copies", "_first")
    )
    expanded = _expand(placed.filter(F.col("_copies") <= COPY_BLOCK), F.col("_first"), F.col("_copies"), name)
    blocks = (
        placed.filter(F.col("_copies") > COPY_BLOCK)
        .withColumn("_skip", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPY_BLOCK))))
        .repartition("_first", "_skip")
    )
    block_rows = F.least(F.lit(COPY_BLOCK).cast("bigint"), F.col("_copies") - F.col("_skip"))
    expanded_blocks = _expand(blocks, F.col("_first") + F.col("_skip"), block_rows, name)
    return expanded.select(*columns, name).unionByName(expanded_blocks.select(*columns, name))


def _expand(df: DataFrame, first: Column, copies: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(first, first + copies - 1)))


def continue_sequence(
    numbered: DataFrame,
    target: DataFrame,
    group: Sequence[str],
    name: str = "update_seq",
) -> DataFrame:
    """Shift 0-based numbers so that each group goes on after the highest number the target holds for it."""
    group = list(group)
    held = target.groupBy(*group).agg((F.max(name) + 1).cast("bigint").alias("_next"))
    shifted = F.col(name) + F.coalesce(F.col("_next"), F.lit(0))
    return numbered.join(held, group, "left").withColumn(name, shifted).select(*numbered.columns)
