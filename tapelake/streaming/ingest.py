"""Recurring pickup of new files with Structured Streaming.

The checkpoint remembers which files were taken, so a run sees only new ones; a ledger beside the table notes what became of them, and
decides which of them are read again: those of data sets that the catalog has learned since. The keep-first load makes a batch that is
replayed after a failure insert nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapelake.operators.layout import BUCKETS
from tapelake.schemas import Feed
from tapelake.streaming import ledger


def raw_stream(spark: SparkSession, spec: Feed, root: str, name_glob: str | None = None, per_batch: int | None = None):
    """New raw files below ``root`` as a stream of raw rows with the version of their file."""
    reader = spark.readStream.schema(ledger.raw_schema(spec)).options(**ledger.raw_options())
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return ledger.with_version(reader.csv(root), spec)


def ingest_new_files(
    spark: SparkSession,
    spec: Feed,
    root: str,
    names: DataFrame,
    table: str,
    checkpoint: str,
    name_glob: str | None = None,
    per_batch: int | None = None,
    sequence: str = "sorted",
    on_invalid: str = "fail",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Load what was held back and is known by now, then start one pass over the files that are new since the last pass; wait on the
    result with ``awaitTermination``.

    ``names`` maps upper-cased symbol (``dataset``), and the raw exchange if it has that column too, to instrument id. Rows of
    other symbols are held back (``ledger.held_back``). Files with invalid rows are refused, or with ``on_invalid="reject"`` loaded
    without these; either way the pass goes on (``ledger.file_states``).
    """
    options = {"sequence": sequence, "on_invalid": on_invalid, "buckets": buckets}
    ledger.pick_up(spark, spec, root, names, table, name_glob, held_only=True, **options)

    def load(batch: DataFrame, _batch_id: int) -> None:
        rows = batch.withColumn("_arrival", F.monotonically_increasing_id())
        noted = ledger.file_states(batch.sparkSession, table).select(*ledger.VERSION).distinct()
        ledger.take(rows.join(noted, ledger.VERSION, "left_anti"), spec, names, table, **options)

    stream = raw_stream(spark, spec, root, name_glob, per_batch)
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
