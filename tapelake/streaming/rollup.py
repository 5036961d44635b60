"""Hourly averages kept up to date from a stream, as partial sums that merge.

The table holds a row of sum and count for each hour, key and *part* of the source, a part being what a batch takes whole: a source
file. Batches only append, and partial sums of one part are the same whoever computed them, so that a batch that is replayed, cut short
and repeated, or read again by a stream begun anew over all or some of the source, changes nothing: readers take each (part, hour, key)
once and merge the parts. No state is kept in the stream.

An hour is final once the table is ``LATENESS`` past it; rows of final hours are refused. ``fold_rollup`` replaces the partial sums
of final hours by one row for each hour and key.

Defined results: rows without time or value add nothing; a null key is a key of its own; an empty stream leaves no table, and reading it is an
error.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapelake.plans import replacement
from tapelake.plans.staging import child_names, file_lengths, path_exists, stage

# How far back an hour may still change, and how often it is refreshed.
LATENESS = dt.timedelta(days=7)
EVERY = "15 minutes"
# The part of folded rows.
FOLDED = ""


def hourly_stream(stream: DataFrame, key: str, value: str, part: str = "_metadata.file_path") -> DataFrame:
    """The rows of a stream with their hour and part, for ``write_rollup``.

    ``part`` names what a batch takes whole and a new stream would take again whole; a source that isn't files needs such a column.
    """
    hour = F.date_trunc("hour", "ts").cast(stream.schema["ts"].dataType)
    rows = stream.select(hour.alias("bucket"), key, F.col(value).alias("_value"), F.col(part).cast("string").alias("_part"))
    return rows.where("bucket IS NOT NULL AND _value IS NOT NULL")


def partial_sums(rows: DataFrame, key: str) -> DataFrame:
    """A row per hour, key and part, with the day of the hour."""
    sums = rows.groupBy("bucket", key, "_part").agg(F.sum("_value").alias("_sum"), F.count("_value").alias("_count"))
    return sums.withColumn("day", F.to_date("bucket"))


def once_per_part(sums: DataFrame, key: str) -> DataFrame:
    """Partial sums without the repeated ones."""
    same = F.max(F.struct("_count", "_sum")).alias("same")
    return sums.groupBy("bucket", key, "_part").agg(same).select("bucket", key, "_part", "same._sum", "same._count")


def merged(sums: DataFrame, key: str) -> DataFrame:
    """Sum and count per hour and key; one shuffle, by hour and key, serves both steps."""
    parts = once_per_part(sums.repartition("bucket", key), key)
    return parts.groupBy("bucket", key).agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))


def _days(spark: SparkSession, path: str) -> list[str]:
    return [name for name in child_names(spark, path) if name.startswith("day=")]


def _newest(spark: SparkSession, path: str, schema: T.StructType, parts: DataFrame | None = None) -> dt.datetime | None:
    """The newest hour of the table, without the given parts; mostly the newest day alone is read."""
    for day in reversed(_days(spark, path)):
        held = replacement.read_table(spark, schema, path, lambda name, day=day: name == day)
        if parts is not None:
            held = held.join(parts, "_part", "left_anti")
        newest = held.agg(F.max("bucket")).first()[0]
        if newest is not None:
            return newest
    return None


def write_rollup(rollup: DataFrame, path: str, checkpoint: str, key: str, once: bool = False) -> StreamingQuery:
    """Keep the rollup table at ``path``, one folder per day: each trigger adds the partial sums of its parts."""

    def save(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        sums = stage(partial_sums(batch, key), "rollup")
        # What the batch itself has added before it was cut short must not make its own rows late.
        newest = _newest(spark, path, sums.schema, sums.select("_part").distinct())
        if newest is not None:
            sums = sums.where(F.col("bucket") > F.lit(newest - LATENESS).cast(sums.schema["bucket"].dataType))
        if not sums.isEmpty():
            sums.hint("rebalance", F.col("day")).write.partitionBy("day").mode("append").parquet(path)

    trigger = {"availableNow": True} if once else {"processingTime": EVERY}
    return rollup.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _schema(spark: SparkSession, path: str) -> T.StructType | None:
    for day in _days(spark, path):
        if file_lengths(spark, f"{path}/{day}"):
            held = spark.read.parquet(f"{path}/{day}").schema
            return T.StructType([*held.fields, T.StructField("day", T.DateType())])
    return None


def fold_rollup(spark: SparkSession, path: str, key: str) -> int:
    """Replace the partial sums of final days by one row for each hour and key; returns the rows written.

    Files are replaced as a set, so what a batch adds meanwhile stays, and a run that died is finished by the next. To be run by
    itself or beside a stream, but not while a stream that stopped in the middle of a batch waits to be started again.
    """
    path = path.rstrip("/")
    replacement.settle(spark, path)
    schema = _schema(spark, path)
    newest = _newest(spark, path, schema) if schema else None
    if newest is None:
        return 0
    final = {day for day in _days(spark, path) if day.removeprefix("day=") < (newest - LATENESS).date().isoformat()}
    files = {day: [f"{day}/{file}" for file in file_lengths(spark, f"{path}/{day}")] for day in sorted(final)}
    old = [file for day in files for file in files[day] if len(files[day]) > 1]
    if not old:
        return 0
    sums = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{file}" for file in old])
    folded = merged(sums, key).withColumn("_part", F.lit(FOLDED)).withColumn("day", F.to_date("bucket"))
    columns = [F.col(field.name).cast(field.dataType) for field in schema]
    name, place = replacement.new_data(path)
    folded.select(*columns).hint("rebalance", F.col("day")).write.partitionBy("day").parquet(place)
    rows = spark.read.schema(schema).parquet(place).count()
    return replacement.finish(spark, replacement.decide(spark, path, name, old, rows))


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """Bucket, key and average of every hour."""
    path = path.rstrip("/")
    schema = _schema(spark, path) if path_exists(spark, path) else None
    if schema is None:
        raise FileNotFoundError(f"no rollup at {path}")
    key = next(name for name in schema.names if name not in ("bucket", "_part", "_sum", "_count", "day"))
    sums = merged(replacement.read_table(spark, schema, path), key)
    return sums.select("bucket", key, (F.col("_sum").cast("double") / F.col("_count")).alias("avg_value"))
