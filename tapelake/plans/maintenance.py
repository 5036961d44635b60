"""Rollups, retention, compaction and size reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.times import as_day, instant_like
from tapelake.operators.layout import BUCKETS, arrange
from tapelake.plans import replacement, summaries
from tapelake.plans.staging import child_names, delete_folder, file_lengths, make_folder, stage
from tapelake.schemas import Feed
from tapelake.session import configure
from tapelake.sources.facts import read_feed_days

# Ages of the documented policies.
COMPACT_AFTER_DAYS = 7
RETAIN_DAYS = 90
# A compacted file may reach about this size.
COMPACT_FILE_BYTES = 512 << 20
REFRESH_FROM = dt.timedelta(days=7)
REFRESH_TO = dt.timedelta(hours=1)


def rollup_avg(df: DataFrame, key: str, value: str, ts: str = "ts") -> DataFrame:
    """Hourly average of ``value`` per key.

    Sum and count are kept apart: the sum of decimals is exact, so the average does not depend on the order of rows.
    """
    hour = F.date_trunc("hour", F.col(ts)).cast(df.schema[ts].dataType)
    return (
        df.groupBy(hour.alias("bucket"), key)
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_count"))
        .select("bucket", key, (F.col("_sum").cast("double") / F.col("_count")).alias("avg_value"))
    )


def refresh_bounds(now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """The whole hours a refresh at ``now`` recomputes: from 7 days ago to 1 hour ago, partly covered hours left out."""
    first, last = now - REFRESH_FROM, now - REFRESH_TO
    start = first.replace(minute=0, second=0, microsecond=0)
    if start < first:
        start += dt.timedelta(hours=1)
    return start, last.replace(minute=0, second=0, microsecond=0)


def in_refresh(df: DataFrame, now: dt.datetime, ts: str = "ts") -> Column:
    start, end = refresh_bounds(now)
    return (F.col(ts) >= instant_like(df, ts, start)) & (F.col(ts) < instant_like(df, ts, end))


def refresh_rollup(held: DataFrame, df: DataFrame, now: dt.datetime, key: str, value: str) -> DataFrame:
    """The rollup after a refresh: recomputed hours replace the held ones, older and newer hours stay as they were."""
    recomputed = rollup_avg(df.filter(in_refresh(df, now)), key, value)
    return held.filter(~in_refresh(held, now, "bucket")).select(*recomputed.columns).unionByName(recomputed)


# A kept rollup: a folder per day of its hours.
ROLLUP = "bucket timestamp, instrument_id string, avg_value double, day date"


def read_kept_rollup(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The hours of a kept rollup, of all days or a range; folders of other days aren't listed."""

    def wanted(name: str) -> bool:
        day = dt.date.fromisoformat(name.removeprefix("day="))
        return (first is None or first <= day) and (last is None or day <= last)

    return replacement.read_table(spark, spark.createDataFrame([], ROLLUP).schema, path, wanted)


def keep_rollup(spark: SparkSession, spec: Feed, facts: str, path: str, now: dt.datetime, value: str = "price") -> int:
    """Refresh a kept hourly rollup of a fact table: the hours of the refresh window are computed anew, older ones stay.

    Only the days of the window are read and rewritten, whatever the length of the history, and compacting the facts changes nothing.
    The files of these days are replaced as a set (``replacement``), so a refresh that dies loses no hour, and readers see each
    once. An hour whose facts are gone is dropped if it is in the window. One refresh at a time; returns the hours of these days.
    """
    path = path.rstrip("/")
    replacement.settle(spark, path)
    start, end = refresh_bounds(now)
    first, last = start.date(), (end - dt.timedelta(microseconds=1)).date()
    held = read_kept_rollup(spark, path, first, last)
    rows = read_feed_days(spark, spec, facts, lambda day: first <= day <= last)
    fresh = refresh_rollup(held, rows, now, "instrument_id", value)
    fresh = stage(fresh.withColumn("day", F.to_date("bucket")).select(*held.columns), "rollup")
    old = [f"{folder}/{file}" for folder in _rollup_days(spark, path, first, last) for file in file_lengths(spark, f"{path}/{folder}")]
    name, data = replacement.new_data(path)
    fresh.hint("rebalance", "day").sortWithinPartitions("day", "instrument_id", "bucket").write.partitionBy("day").parquet(data)
    for folder in child_names(spark, data):
        if folder.startswith("day="):
            make_folder(spark, f"{path}/{folder}")
    replacement.finish(spark, replacement.decide(spark, path, name, old, 0))
    return fresh.count()


def _rollup_days(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> list[str]:
    names = [name for name in child_names(spark, path) if name.startswith("day=")]
    return [name for name in names if first <= dt.date.fromisoformat(name.removeprefix("day=")) <= last]


def retained(df: DataFrame, as_of: dt.date | str, days: int = RETAIN_DAYS) -> DataFrame:
    """Rows of days not older than ``days`` before ``as_of``."""
    return df.filter(F.col("trading_day") >= F.lit(as_day(as_of) - dt.timedelta(days=days)))


def expired_days(df: DataFrame, as_of: dt.date | str, days: int = RETAIN_DAYS) -> DataFrame:
    """Days that retention would drop."""
    old = F.col("trading_day") < F.lit(as_day(as_of) - dt.timedelta(days=days))
    return df.filter(old).select("trading_day").distinct()


def drop_expired(spark: SparkSession, table: str, as_of: dt.date | str, days: int = RETAIN_DAYS) -> int:
    """Drop the expired day partitions of a managed table: a change of metadata and files, no rewrite. Returns the number
    of dropped partitions (bounded by days x buckets)."""
    cutoff = as_day(as_of) - dt.timedelta(days=days)
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    day = F.to_date(F.regexp_extract("partition", r"trading_day=(\d{4}-\d{2}-\d{2})", 1))
    old = [r.partition for r in listed.filter(day < F.lit(cutoff)).collect()]
    if old:
        specs = []
        for partition in old:
            parts = [p.split("=", 1) for p in partition.split("/")]
            specs.append("PARTITION (" + ", ".join(f"{name}='{value}'" for name, value in parts) + ")")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
    return len(old)


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days a table has folders of, from one listing."""
    prefix = "trading_day="
    return sorted(dt.date.fromisoformat(n.removeprefix(prefix)) for n in child_names(spark, path) if n.startswith(prefix))


def drop_expired_days(spark: SparkSession, path: str, as_of: dt.date | str, days: int = RETAIN_DAYS) -> int:
    """Drop the expired day folders of a table at a path; contents are not read. Returns the number of days."""
    cutoff = as_day(as_of) - dt.timedelta(days=days)
    old = [day for day in stored_days(spark, path) if day < cutoff]
    for day in old:
        delete_folder(spark, f"{path}/trading_day={day}")
        delete_folder(spark, f"{path}/{summaries.SUMMARY}/trading_day={day}")
    return len(old)


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of the Parquet files below ``path``, from the listing alone (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "length")


def fragmented_days(
    spark: SparkSession, path: str, before: dt.date | str, file_bytes: int = COMPACT_FILE_BYTES
) -> DataFrame:
    """Days before ``before`` that have a bucket with clearly more files than a rewrite would leave.

    A rewrite aims at files of ``file_bytes`` before compression and sorting, so what it leaves is taken to reach a quarter of
    that at least; a bucket of a single file has nothing to gain.
    """
    day = F.to_date(F.regexp_extract("path", r"trading_day=(\d{4}-\d{2}-\d{2})", 1))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return (
        table_files(spark, path)
        .groupBy(day.alias("trading_day"), folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes"))
        .filter(F.col("trading_day") < F.lit(as_day(before)))
        .filter(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / F.lit(file_bytes // 4))))
        .select("trading_day")
        .distinct()
    )


# Files of cold days that one replacement takes at most, unless a single day has more: what the driver lists and notes at a time.
FILES_AT_ONCE = 10_000


def resume_compaction(spark: SparkSession, path: str) -> int:
    """Finish a compaction whose driver was lost; returns the rows of the files it put in place, 0 if there was none."""
    return replacement.settle(spark, path)


def prepare_compaction(
    spark: SparkSession,
    path: str,
    old: list[str],
    buckets: int = BUCKETS,
    segment_by: str = "instrument_id",
    file_bytes: int = COMPACT_FILE_BYTES,
) -> replacement.Replacement:
    """Write the rows of some files (paths below the table) as few sorted ones, hidden, and decide that they take their place."""
    session = configure(spark.newSession())  # has its own settings, so those of the caller stay
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))  # what a task, and so a file, may reach
    cold = session.read.option("basePath", path).parquet(*[f"{path}/{file}" for file in old])
    rows = cold.count()
    name, data = replacement.new_data(path)
    written = Observation(f"compacted-{name}")
    dealt = arrange(cold.drop("instr_bucket"), buckets, (written, F.count(F.lit(1)).alias("rows")), segment_by)
    dealt.write.partitionBy("trading_day", "instr_bucket").parquet(data)
    if written.get["rows"] != rows:
        raise RuntimeError(f"compaction read {rows} rows but wrote {written.get['rows']}")
    return replacement.decide(spark, path, name, old, rows)


def compact_cold(
    spark: SparkSession,
    path: str,
    as_of: dt.date | str,
    days: int = COMPACT_AFTER_DAYS,
    buckets: int = BUCKETS,
    segment_by: str = "instrument_id",
    file_bytes: int = COMPACT_FILE_BYTES,
) -> int:
    """Rewrite the fragmented days older than ``days`` as few files, sorted by ``segment_by`` and time. Returns the number of
    rows rewritten.

    Days that are compact already are left alone, so a daily run costs what became cold since the last one. Files are replaced as
    a set (``replacement``): rows that a load adds meanwhile stay, and a run that dies is finished by the next one.
    """
    path = path.rstrip("/")
    done = resume_compaction(spark, path)
    before = as_day(as_of) - dt.timedelta(days=days)
    held: list[str] = []

    def rewrite() -> int:
        return replacement.finish(spark, prepare_compaction(spark, path, held, buckets, segment_by, file_bytes)) if held else 0

    for row in fragmented_days(spark, path, before, file_bytes).orderBy("trading_day").collect():
        files = day_files(spark, path, row.trading_day)
        if len(held) + len(files) > FILES_AT_ONCE:
            done, held = done + rewrite(), []
        held = held + files
    return done + rewrite()


def day_files(spark: SparkSession, path: str, day: dt.date) -> list[str]:
    """The files of a day, as paths below the table."""
    folder = f"trading_day={day}"
    return [f"{folder}/{file}" for file in file_lengths(spark, f"{path.rstrip('/')}/{folder}") if file.endswith(".parquet")]


def storage_report(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Files and bytes per table, from the file listing alone (contents are not read)."""
    report = None
    for name, path in tables.items():
        files = table_files(spark, path).withColumn("table_name", F.lit(name))
        report = files if report is None else report.unionByName(files)
    return report.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes")
    )


def day_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per trading day of one table."""
    day = F.to_date(F.regexp_extract("path", r"trading_day=(\d{4}-\d{2}-\d{2})", 1))
    sizes = table_files(spark, path).groupBy(day.alias("trading_day"))
    return sizes.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes"))
