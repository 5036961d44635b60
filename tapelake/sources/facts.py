"""Reading the stored tables, and rows from column arrays."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.times import day_range, instant_like
from tapelake.operators.layout import BUCKETS, bucket_filter
from tapelake.plans.replacement import read_table
from tapelake.plans.staging import read_or_empty
from tapelake.schemas import INSTRUMENT, Feed


def read_feed(spark: SparkSession, spec: Feed, path: str) -> DataFrame:
    return read_table(spark, spec.fact, path)


def read_feed_days(spark: SparkSession, spec: Feed, path: str, wanted: Callable[[dt.date], bool]) -> DataFrame:
    """The rows of the days that ``wanted`` accepts.

    One listing of the table's folder gives its days; the folders of other days, of which a long history has very many, are
    not even listed.
    """
    return read_table(spark, spec.fact, path, lambda name: wanted(dt.date.fromisoformat(name.removeprefix("trading_day="))))


def in_days(df: DataFrame, start: dt.date | str, end: dt.date | str | None = None) -> DataFrame:
    """Rows of the half-open range [start 00:00, end + 1 day 00:00) in UTC.

    The range on ``ts`` reaches the file reader; the equal range on ``trading_day``, where there is that column, prunes
    partitions.
    """
    first, last = day_range(start, end)
    rows = df.filter(F.col("ts") >= instant_like(df, "ts", first))
    rows = rows.filter(F.col("ts") < instant_like(df, "ts", last + dt.timedelta(days=1)))
    if "trading_day" in df.columns:
        rows = rows.filter(F.col("trading_day").between(F.lit(first), F.lit(last)))
    return rows


def scan_feed(
    spark: SparkSession,
    spec: Feed,
    path: str,
    start: dt.date | str,
    end: dt.date | str | None = None,
    instruments: Iterable[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of a day range and, if given, of some instruments; other days and buckets are not opened."""
    first, last = day_range(start, end)
    rows = in_days(read_feed_days(spark, spec, path, lambda day: first <= day <= last), first, last)
    if instruments is not None:
        ids = list(instruments)
        rows = rows.filter(bucket_filter(ids, buckets)).filter(F.col("instrument_id").isin(ids))
    return rows.drop("instr_bucket")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The flat instrument table, one partition per exchange."""
    return read_or_empty(spark, path, INSTRUMENT)


def dataset_map(instruments: DataFrame, exchange: str | None = None, instrument_type: str | None = None) -> DataFrame:
    """Upper-cased data set name to instrument id, optionally of one exchange and type."""
    rows = instruments
    if exchange is not None:
        rows = rows.filter(F.col("exchange") == exchange)
    if instrument_type is not None:
        rows = rows.filter(F.col("instrument_type") == instrument_type)
    name = F.upper("dataset")
    return rows.filter(F.col("dataset").isNotNull() & (name != "")).select(name.alias("dataset"), "instrument_id")


def rows_from_arrays(df: DataFrame, columns: dict[str, str], sort: bool = True) -> DataFrame:
    """Parallel array columns to rows, each array cast to the given type; shorter arrays are filled up with nulls.

    Rows are ordered by instrument and time within each partition, unless ``sort`` is off: a write sorts anyway."""
    zipped = F.arrays_zip(*[F.col(name).alias(name) for name in columns])
    rows = df.select(F.inline(zipped)).select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])
    return rows.sortWithinPartitions("instrument_id", "ts") if sort else rows
