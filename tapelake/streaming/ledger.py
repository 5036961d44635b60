"""What became of every source file: a ledger beside the table decides what a pickup reads.

A row per file, version (length and time of change), exchange and data set, with its state:

- ``loaded``: the rows of a known data set are in the table (``invalid`` of them were left out for a reason);
- ``held``: the catalog didn't know the data set; the file is read again as soon as it does;
- ``rejected``: the file has invalid rows or malformed lines and such files are refused as a whole. It is read again when it is
  delivered anew. A row without data set counts the malformed lines of a file, whether it was refused or not;
- ``empty``: no line of the file has a time.

A pickup lists the files, takes away those that the ledger settles by an anti-join, and reads what is left, ``FILES_AT_ONCE`` at a time.
Rows are noted after they are loaded: what a lost driver loaded and didn't note is read again, and the keep-first load inserts nothing. Level
updates are numbered over all rows of their file before any are held back, so a row gets the same number whenever it is loaded.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.operators.layout import BUCKETS, stored_buckets
from tapelake.operators.normalize import normalize_levels, normalize_trades
from tapelake.operators.validate import check_facts
from tapelake.plans.load import LoadReport, append_feed, numbered_levels
from tapelake.plans.staging import existing_paths, path_exists, stage
from tapelake.schemas import TRADES, Feed
from tapelake.sources.raw_files import csv_options

# Beside the table's day folders and hidden from its readers.
FILES = "_files"
FILES_AT_ONCE = 10_000
LOADED, HELD, REJECTED, EMPTY = "loaded", "held", "rejected", "empty"
MALFORMED = "malformed line"

VERSION = ["path", "length", "modified"]
DATASET = ["exchange", "dataset"]
LEDGER = "path string, length bigint, modified timestamp, exchange string, dataset string, state string, rows bigint, invalid bigint, reason string, noted bigint"
# Columns of raw rows beside those of the feed: the version of their file, arrival order, and the text of a malformed line.
BROKEN = "_broken"


def raw_schema(spec: Feed) -> T.StructType:
    return T.StructType([*spec.raw.fields, T.StructField(BROKEN, T.StringType())])


def raw_options() -> dict[str, str]:
    """Malformed lines are kept apart, so that one of them doesn't stop the others."""
    return csv_options("PERMISSIVE") | {"columnNameOfCorruptRecord": BROKEN}


def with_version(rows: DataFrame, spec: Feed) -> DataFrame:
    """Raw rows with the version of their file."""
    meta = {"path": "file_path", "length": "file_size", "modified": "file_modification_time"}
    return rows.select(*spec.raw.names, BROKEN, *[F.col(f"_metadata.{field}").alias(name) for name, field in meta.items()])


# ---- the ledger ---------------------------------------------------------------------------------------------------------
def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """Every note of a table's ledger."""
    place = f"{table.rstrip('/')}/{FILES}"
    # Hidden folders are read by the names of their files.
    notes = existing_paths(spark, f"{place}/part-*.parquet") if path_exists(spark, place) else []
    return spark.read.schema(LEDGER).parquet(f"{place}/part-*.parquet") if notes else spark.createDataFrame([], LEDGER)


def file_states(spark: SparkSession, table: str) -> DataFrame:
    """The last state of each file's data sets, in the last version that was taken."""
    ledger = read_ledger(spark, table)
    file = Window.partitionBy("path")
    newest = F.max(F.struct("noted", "length", "modified")).over(file)
    ledger = ledger.withColumn("newest", newest).where((F.col("length") == F.col("newest.length")) & (F.col("modified") == F.col("newest.modified")))
    last = F.row_number().over(Window.partitionBy("path", *DATASET).orderBy(F.desc("noted")))
    return ledger.withColumn("last", last).where("last = 1").drop("last", "newest")


def held_back(spark: SparkSession, table: str) -> DataFrame:
    """Files that wait for the catalog to know a data set of theirs."""
    return file_states(spark, table).where(F.col("state") == HELD)


def _key(names: DataFrame) -> list[str]:
    return [c for c in DATASET if c in names.columns]


def unsettled(spark: SparkSession, table: str, files: DataFrame, names: DataFrame) -> DataFrame:
    """Those of the listed files (path, length, modified) to be read: new versions, and held ones whose data set is known by now."""
    states = stage(file_states(spark, table), "files")
    known = states.where(F.col("state") == HELD).join(names.select(*_key(names)).distinct(), _key(names), "left_semi")
    settled = states.select(*VERSION).distinct().join(known.select("path").distinct(), "path", "left_anti")
    return files.join(settled, VERSION, "left_anti")


def _note(notes: DataFrame, table: str) -> None:
    row = notes.withColumn("noted", F.lit(time.time_ns()))
    row.select(*[F.col(f.name).cast(f.dataType) for f in notes.sparkSession.createDataFrame([], LEDGER).schema]).coalesce(1).write.mode("append").parquet(
        f"{table.rstrip('/')}/{FILES}"
    )


# ---- taking files -------------------------------------------------------------------------------------------------------
def list_files(spark: SparkSession, root: str, name_glob: str | None = None) -> DataFrame:
    """Path, length and time of change of the files below ``root``; contents are not read."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", name_glob) if name_glob else files
    return files.load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def _states(checked: DataFrame, whole: bool) -> DataFrame:
    """What becomes of the files, per data set, from their checked rows."""
    broken, unknown = F.col("reason") == MALFORMED, F.col("instrument_id").isNull()
    lines = F.coalesce(broken, F.lit(False))
    timed = lines | F.col("ts").isNotNull()
    bad = timed & (lines | (~unknown & F.col("reason").isNotNull()))
    # Malformed lines belong to no data set, since what they say of it can't be relied on; nor do rows without a time.
    of = [F.when(timed & ~lines, F.col(c)).alias(c) for c in DATASET]
    sums = checked.groupBy(*VERSION, *of, timed.alias("timed")).agg(
        F.count("*").alias("rows"),
        F.count(F.when(bad, 1)).alias("invalid"),
        F.min(F.when(bad, F.col("reason"))).alias("reason"),
        F.max(unknown).alias("unknown"),
        F.max(lines).alias("lines"),
    )
    file = Window.partitionBy(*VERSION)
    refused = F.col("lines") | (F.lit(whole) & (F.sum("invalid").over(file) > 0))
    state: Column = F.when(~F.col("timed"), EMPTY).when(refused, REJECTED).when(F.col("unknown"), HELD).otherwise(LOADED)
    found = sums.withColumn("state", state).withColumn("any", F.max("timed").over(file))
    return found.where("timed OR NOT any").select(*VERSION, *DATASET, "state", "rows", "invalid", "reason")


def take(rows: DataFrame, spec: Feed, names: DataFrame, table: str, sequence: str = "sorted", on_invalid: str = "fail", buckets: int = BUCKETS) -> LoadReport:
    """Load the raw rows of some files (with their version, ``_arrival`` and malformed lines) and note what became of them.

    ``names`` maps the upper-cased symbol (``dataset``), and the raw exchange if it has that column too, to the instrument id.
    """
    spark = rows.sparkSession
    if spec is not TRADES:
        raw = stage(rows, "taken")
        odd = raw.where(F.col(BROKEN).isNotNull() | F.col("timestamp").isNull())
        fine = raw.where(F.col(BROKEN).isNull() & F.col("timestamp").isNotNull())
        rows = numbered_levels(fine, sequence, VERSION, unique=True).unionByName(odd, allowMissingColumns=True)
    known = rows.withColumn("dataset", F.upper("symbol")).join(names, _key(names), "left")
    normal = (normalize_trades if spec is TRADES else normalize_levels)(known, keep=[*VERSION, *DATASET, BROKEN], timed=False)
    reason = F.when(F.col(BROKEN).isNotNull(), MALFORMED).otherwise(F.col("reason"))
    checked = stage(check_facts(normal, spec).withColumn("reason", reason).drop(BROKEN), "checked")
    states = stage(_states(checked, on_invalid == "fail"), "states")
    good = states.where(F.col("state") == LOADED).select(*VERSION).distinct()
    loadable = F.col("instrument_id").isNotNull() & F.col("ts").isNotNull() & ~F.col("reason").eqNullSafe(MALFORMED)
    loaded = checked.where(loadable).join(good, VERSION, "left_semi").select(*spec.columns)
    report = append_feed(loaded, spec, table, on_invalid="reject", buckets=stored_buckets(spark, table) or buckets, staged=True)
    _note(states, table)
    return report


def pick_up(
    spark: SparkSession,
    spec: Feed,
    root: str,
    names: DataFrame,
    table: str,
    name_glob: str | None = None,
    sequence: str = "sorted",
    on_invalid: str = "fail",
    buckets: int = BUCKETS,
    held_only: bool = False,
) -> LoadReport:
    """Load the files below ``root`` that the ledger doesn't settle. Returns the sums of the loads; ``file_states`` tells of each file.

    ``on_invalid="fail"`` refuses a file with an invalid row or a malformed line as a whole, ``"reject"`` loads its good rows; the
    other files are loaded either way.
    """
    total = LoadReport()
    if held_only and held_back(spark, table).isEmpty():
        return total
    while True:
        files = list_files(spark, root, name_glob)
        if held_only:
            files = files.join(held_back(spark, table).select("path").distinct(), "path", "left_semi")
        some = unsettled(spark, table, files, names).orderBy("path").limit(FILES_AT_ONCE).collect()
        if not some:
            return total
        reader = spark.read.schema(raw_schema(spec)).options(**raw_options())
        rows = with_version(reader.csv([row.path for row in some]), spec).withColumn("_arrival", F.monotonically_increasing_id())
        report = take(rows, spec, names, table, sequence, on_invalid, buckets)
        total.received += report.received
        total.inserted += report.inserted
        total.rejected += report.rejected
        total.days = sorted({*total.days, *report.days})
        for reason, n in report.reasons.items():
            total.reasons[reason] = total.reasons.get(reason, 0) + n
        taken = spark.createDataFrame([tuple(row) for row in some], files.schema)
        left = unsettled(spark, table, taken, names)  # what has no line at all
        _note(left.withColumn("state", F.lit(EMPTY)).select(*VERSION, "state").withColumns({c: F.lit(None) for c in (*DATASET, "rows", "invalid", "reason")}), table)
