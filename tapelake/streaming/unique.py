"""An endless stream without repeated keys, and its table.

State that expires recognizes copies that arrive up to a delay after their first row. It expires by the time of arrival, not by the
rows' own time: by that no row is ever late, so none is dropped, however old. What the state may have forgotten is compared with the
table: a key that arrived more than the delay ago is of a time before that, so only rows older than the delay need it, and
only the days they are of are read.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapelake.plans.staging import child_names, path_exists, read_text, stage, write_text

# How long copies are recognized without a look at the table, and how far a source's clock may be ahead.
DELAY = dt.timedelta(days=1)
LEAD = dt.timedelta(hours=1)
# When a row was taken: the time of its batch, the same if the batch is replayed.
ARRIVED = "_arrived"
# Beside the day folders and hidden from readers.
NOTES = "_batches"
MOMENT = "%Y-%m-%d %H:%M:%S.%f"


def _with_arrival(stream: DataFrame, keys: list[str], delay: dt.timedelta, lead: dt.timedelta) -> DataFrame:
    kept = f"{int((delay + lead).total_seconds())} seconds"
    return stream.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, kept).dropDuplicatesWithinWatermark(keys)


def unique_stream(stream: DataFrame, keys: list[str], delay: dt.timedelta = DELAY, lead: dt.timedelta = LEAD) -> DataFrame:
    """The stream without copies that arrive up to ``delay`` after their first row; a null key is a key. Nothing else is dropped."""
    return _with_arrival(stream, keys, delay, lead).drop(ARRIVED)


def _days(spark: SparkSession, path: str) -> dict[str, str]:
    return {name.removeprefix("day="): name for name in child_names(spark, path) if name.startswith("day=")}


def read_unique(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table kept by ``write_unique``."""
    return spark.read.parquet(path).drop("day")


def _not_held(rows: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows whose key the table doesn't have. Only the days of the rows are read (the driver gets these alone)."""
    spark, there = rows.sparkSession, _days(rows.sparkSession, path)
    names = [there[str(row[0])] for row in rows.select(F.coalesce(F.col("day").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))).distinct().collect() if str(row[0]) in there]
    if not names:
        return rows
    held = spark.read.schema(rows.drop("day").schema).parquet(*[f"{path}/{name}" for name in names])
    # As a struct, nulls are equal to each other.
    held = held.select(F.struct(*keys).alias("_key")).distinct()
    return rows.withColumn("_key", F.struct(*keys)).join(held, "_key", "left_anti").select(*rows.columns)


def write_unique(
    stream: DataFrame,
    keys: list[str],
    path: str,
    checkpoint: str,
    delay: dt.timedelta = DELAY,
    lead: dt.timedelta = LEAD,
    once: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Keep the table at ``path``, one folder per day of ``ts``, with one row per key, whichever arrives first.

    ``ts`` must be among the keys: copies then are of one day. A batch that is replayed is compared with the table as a whole; so are
    rows from before the first batch of a checkpoint, as a stream begun anew has forgotten what an earlier one took. One stream
    writes a table at a time. Rows without ``ts`` have a folder of their own and are compared always.
    """
    if "ts" not in keys:
        raise ValueError("ts must be among the keys")
    path = path.rstrip("/")
    run = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def begun(spark: SparkSession, batch_id: int, now: dt.datetime) -> tuple[dt.datetime, bool]:
        """When this checkpoint's first batch ran, and whether this batch was begun before; notes its beginning."""
        notes = f"{path}/{NOTES}/{run}"
        first, last = f"{notes}/first", f"{notes}/last"
        again = path_exists(spark, last) and int(read_text(spark, last)) >= batch_id
        if not path_exists(spark, first):
            write_text(spark, first, now.strftime(MOMENT))
        write_text(spark, last, str(batch_id))
        return dt.datetime.strptime(read_text(spark, first), MOMENT), again

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch.withColumn("day", F.to_date("ts")), "unique")
        if rows.isEmpty():
            return
        now = rows.agg(F.max(ARRIVED)).first()[0]
        first, again = begun(spark, batch_id, now)
        rows = rows.drop(ARRIVED)
        if again:
            fresh = _not_held(rows, path, keys)
        else:
            known: Column = F.coalesce(F.col("ts") >= F.lit(max(now - delay, first + lead)).cast(rows.schema["ts"].dataType), F.lit(False))
            fresh = rows.where(known).unionByName(_not_held(rows.where(~known), path, keys))
        # The table is read while it is added to, so what is new is settled first.
        stage(fresh, "unique").hint("rebalance", F.col("day")).write.partitionBy("day").mode("append").parquet(path)

    trigger = {"availableNow": True} if once else {"processingTime": every}
    writer = _with_arrival(stream, keys, delay, lead).writeStream.foreachBatch(save)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
