"""Keep-first de-duplication and anti-joins on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark turns the ``= 1`` filter into a group limit that already runs before the shuffle, so a key with very many copies
    sends one row per map task and never gathers in one place.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def not_in(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``target``.

    The target is reduced to its distinct keys first (combined before the shuffle), so a key repeated there costs nothing.
    """
    return df.join(target.select(*keys).distinct(), list(keys), "left_anti").select(*df.columns)


def new_rows(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """Keep-first insert: duplicates within the batch collapse to one, keys the target has are left out.

    Both steps hash on the same key columns, so the batch is shuffled once.
    """
    return not_in(first_per_key(batch, keys, order), target, keys)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def conflicting_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys a strict insert trips over: repeated within the batch, or held by the target already."""
    batch_keys = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    held = target.select(*keys).distinct().withColumn("_held", F.lit(1))
    return (
        batch_keys.join(held, list(keys), "left")
        .select(*keys, "copies", F.col("_held").isNotNull().alias("in_target"))
        .filter((F.col("copies") > 1) | F.col("in_target"))
    )
