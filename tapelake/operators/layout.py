"""The stored layout: one folder per day and instrument bucket, files sorted by (instrument, time)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapelake.plans.staging import path_exists

BUCKETS = 64
# Kept beside the day folders, hidden from readers of the table.
LAYOUT = "_layout"


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a table is written with; none if there is no table yet.

    A note without a day folder beside it is what a first write left that didn't end; it counts for nothing.
    """
    place = f"{path.rstrip('/')}/{LAYOUT}"
    if not path_exists(spark, place) or not path_exists(spark, f"{path.rstrip('/')}/*=*"):
        return None
    # Hidden folders are read by the names of their files.
    return spark.read.schema("buckets int").json(f"{place}/part-*.json").first()[0]


def check_buckets(spark: SparkSession, path: str, buckets: int) -> int | None:
    """The number of buckets of a table, if there is one; another number than the given one is an error. Nothing is written."""
    held = stored_buckets(spark, path)
    if held not in (None, buckets):
        raise ValueError(f"{path} has {held} buckets, not {buckets}")
    return held


def settle_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Note the number of buckets of a table that is about to get its first rows."""
    if check_buckets(spark, path, buckets) is None:
        note = spark.createDataFrame([(buckets,)], "buckets int").coalesce(1)
        note.write.mode("overwrite").json(f"{path.rstrip('/')}/{LAYOUT}")


def instrument_bucket(instrument_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(instrument_id.cast("string")), F.lit(buckets)).cast("int")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Deal rows that are about to become many each (a row per day, say) over all shuffle partitions, by the hash of some columns.

    A small table is read by one task, and what its rows become would all be made, and aggregated, in that task. A number of
    partitions is given because adaptive execution would pack the few bytes there are before that into one partition again.
    """
    number = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(number, *[F.col(c) for c in columns])


def arrange(
    df: DataFrame,
    buckets: int = BUCKETS,
    observe: tuple[Observation, Column] | None = None,
    segment_by: str = "instrument_id",
) -> DataFrame:
    """Bring the rows of a (day, bucket) together, sorted by ``segment_by`` and time.

    ``rebalance`` rather than ``repartition``: a hot (day, bucket) is split over several tasks and files, and small ones are
    packed together. An ``observe`` pair is measured between shuffle and sort, that is in the stage that writes, where
    every row is counted once. The sort comes last, so the writer finds its order and does not sort again.
    """
    rows = df.withColumn("instr_bucket", instrument_bucket(F.col("instrument_id"), buckets)).hint(
        "rebalance", F.col("trading_day"), F.col("instr_bucket")
    )
    if observe is not None:
        rows = rows.observe(*observe)
    return rows.sortWithinPartitions("trading_day", "instr_bucket", segment_by, "ts")


def write_layout(
    df: DataFrame,
    path: str,
    buckets: int = BUCKETS,
    mode: str = "append",
    observe: tuple[Observation, Column] | None = None,
    segment_by: str = "instrument_id",
) -> None:
    """Append to a table, or (``overwrite``) replace just the partitions that ``df`` has rows for."""
    settle_buckets(df.sparkSession, path, buckets)
    (
        arrange(df, buckets, observe, segment_by)
        .write.partitionBy("trading_day", "instr_bucket")
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(path)
    )


def bucket_filter(instruments: Iterable[str], buckets: int = BUCKETS) -> Column:
    """The buckets of some literal instruments, as a partition filter."""
    return F.col("instr_bucket").isin([instrument_bucket(F.lit(i), buckets) for i in instruments])
