"""One row per instrument and day of a stored table, kept beside it, so that coverage questions open no fact file.

``_summary/trading_day=<day>`` holds count, first and last time per instrument, with its bucket. A load marks its days in
``_summary_stale`` before it appends, counts the (day, bucket) pairs it touched anew, and takes the marks away; a day that stays marked
(its load died), or that has no summary (it was written by other means than a load), is counted from the facts until the next load or
``refresh`` mends it. Days and marks are found by two listings of folder names. One writer per feed and day is assumed, as by loads.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.plans.replacement import read_table
from tapelake.plans.staging import child_names, remove_file, stage, write_text
from tapelake.schemas import Feed

# Beside the table's day folders and hidden from its readers.
SUMMARY = "_summary"
STALE = "_summary_stale"
_DAY = "trading_day="

ROW = T.StructType(
    [
        T.StructField("instrument_id", T.StringType()),
        T.StructField("instr_bucket", T.IntegerType()),
        T.StructField("items_count", T.LongType()),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("trading_day", T.DateType()),
    ]
)


def _days(names: Iterable[str]) -> set[dt.date]:
    return {dt.date.fromisoformat(name.removeprefix(_DAY)) for name in names if name.startswith(_DAY)}


def table_days(spark: SparkSession, path: str) -> set[dt.date]:
    return _days(child_names(spark, path.rstrip("/")))


def kept_days(spark: SparkSession, path: str) -> set[dt.date]:
    """The days whose summary can be relied on."""
    path = path.rstrip("/")
    kept = _days(child_names(spark, f"{path}/{SUMMARY}"))
    return kept - _days(child_names(spark, f"{path}/{STALE}")) if kept else kept


def mark(spark: SparkSession, path: str, days: Iterable[dt.date]) -> None:
    """Tell that the summaries of some days are no longer to be relied on."""
    for day in days:
        write_text(spark, f"{path.rstrip('/')}/{STALE}/{_DAY}{day}", "")


def unmark(spark: SparkSession, path: str, days: Iterable[dt.date]) -> None:
    for day in days:
        remove_file(spark, f"{path.rstrip('/')}/{STALE}/{_DAY}{day}")


def _counted(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("instrument_id", "instr_bucket", "trading_day").agg(
        F.count(F.lit(1)).alias("items_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return sums.select(*ROW.names)


def _facts(spark: SparkSession, spec: Feed, path: str, days: set[dt.date]) -> DataFrame:
    return read_table(spark, spec.fact, path, lambda name: dt.date.fromisoformat(name.removeprefix(_DAY)) in days)


def _summary(spark: SparkSession, path: str, days: Iterable[dt.date]) -> DataFrame:
    base = f"{path.rstrip('/')}/{SUMMARY}"
    folders = [f"{base}/{_DAY}{day}" for day in sorted(days)]
    return spark.read.schema(ROW).option("basePath", base).parquet(*folders) if folders else spark.createDataFrame([], ROW)


def in_pairs(pairs: Mapping[dt.date, set[int] | None]) -> Column:
    """Rows of some (day, bucket) pairs, as a condition on folder columns; None stands for every bucket of a day."""
    by_buckets: dict[frozenset | None, list[dt.date]] = {}
    for day, buckets in pairs.items():
        by_buckets.setdefault(None if buckets is None else frozenset(buckets), []).append(day)
    found = F.lit(False)
    for buckets, days in by_buckets.items():
        these = F.col("trading_day").isin([F.lit(day) for day in sorted(days)])
        found |= these if buckets is None else these & F.col("instr_bucket").isin(sorted(buckets))
    return found


def refresh(spark: SparkSession, spec: Feed, path: str, pairs: Mapping[dt.date, set[int]], sound: set[dt.date]) -> None:
    """Count some (day, bucket) pairs anew; of days that aren't ``sound``, having had no reliable summary, all buckets."""
    whole = {day: buckets if day in sound else None for day, buckets in pairs.items()}
    new = _counted(_facts(spark, spec, path, set(whole)).where(in_pairs(whole)))
    partly = {day: buckets for day, buckets in whole.items() if buckets is not None}
    if partly:
        new = new.unionByName(_summary(spark, path, partly).where(~in_pairs(partly)))
        new = stage(new, "summary")  # a summary is never read and overwritten by one job
    writer = new.hint("rebalance", F.col("trading_day")).write.partitionBy("trading_day")
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path.rstrip('/')}/{SUMMARY}")
    unmark(spark, path, pairs)


def mend(spark: SparkSession, spec: Feed, path: str) -> list[dt.date]:
    """Summarise the days of a table that have no reliable summary; returns them."""
    days = sorted(table_days(spark, path) - kept_days(spark, path))
    if days:
        refresh(spark, spec, path, {day: set() for day in days}, set())
    return days


def day_rows(
    spark: SparkSession,
    spec: Feed,
    path: str,
    wanted: Callable[[dt.date], bool] = lambda _: True,
    pairs: Mapping[dt.date, set[int]] | None = None,
) -> DataFrame:
    """Count, first and last time per instrument of the wanted days: from the summary, and from the facts where there is none.

    With ``pairs`` only those (day, bucket) pairs are answered for, and of the facts only their folders are opened.
    """
    days = {day for day in table_days(spark, path) if wanted(day)}
    kept = kept_days(spark, path) & days
    rows = _summary(spark, path, kept)
    if days - kept:
        more = _facts(spark, spec, path, days - kept)
        if pairs is not None:
            more = more.where(in_pairs({day: pairs.get(day, set()) for day in days - kept}))
        rows = rows.unionByName(_counted(more))
    return rows.withColumn("feed", F.lit(spec.name))
