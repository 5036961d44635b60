"""Landing raw rows: the day file of a data set, kept as delivered, with its name and the order of its lines.

The table of rows only grows: a landing appends the rows of the data set days whose content is new, under an id of its own, and then
notes them in a ledger beside the table (data set day, landing, digest of its rows, version of its source files). Readers take of every
data set day the rows of the landing that the ledger names last. So

- what holds the same rows as before, in the same order, isn't written again, and a source file that was neither touched nor resized
  since isn't even read;
- other data sets of the folder aren't rewritten;
- a landing that breaks off before its entry is whole left rows nobody reads, and is simply repeated.

``fold_landed`` removes the rows nobody reads. One landing or fold of a table at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.plans import replacement
from tapelake.plans.load import few_requested, for_requests, requested_instruments
from tapelake.plans.staging import child_names, delete_folder, file_lengths, path_exists, stage, write_text
from tapelake.schemas import Feed

VENUE_DAY = ["feed", "trading_day", "venue"]
# What is replaced by landing it again, and the folders that hold it. The day comes first: readers list the days they want.
LANDED = [*VENUE_DAY, "dataset"]
FOLDERS = ["trading_day", "feed", "venue"]
# Where each row comes from: file and place in it, so that arrival order can be rebuilt.
ORIGIN = ["_file", "_arrival"]

# Beside the day folders and hidden from their readers.
LEDGER = "_ledger"
KEYS = "feed string, trading_day date, venue string, dataset string"
ENTRY = f"{KEYS}, number bigint, landing string, row_count bigint, digest string, version string"


@dataclass(frozen=True)
class Landing:
    """Data set days of a landing: written, read but found to hold what is there already, and not read at all."""

    written: int
    unchanged: int
    skipped: int = 0


def landed_rows(raw: DataFrame, spec: Feed, venue: Column, day: Column) -> DataFrame:
    """Raw rows with their origin (null where they have none) and the folder columns of the landing table."""
    kinds = dict(zip(ORIGIN, ("string", "bigint"), strict=True))
    origin = [(F.col(c) if c in raw.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
    folder = [F.lit(spec.tag).alias("feed"), day.alias("trading_day"), venue.alias("venue"), F.upper("dataset").alias("dataset")]
    return raw.select(*spec.raw.names, *origin, *folder)


# ---- the ledger -------------------------------------------------------------------------------------------------------
def _entries(spark: SparkSession, path: str, whole: bool = True) -> list[str]:
    """Names of the ledger's entries in order; those without a note at their end are of landings that broke off."""
    place = f"{path.rstrip('/')}/{LEDGER}"
    return [name for name in child_names(spark, place) if not whole or path_exists(spark, f"{place}/{name}/done")]


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every data set day as it was landed last."""
    path = path.rstrip("/")
    places = [f"{path}/{LEDGER}/{name}/rows" for name in _entries(spark, path)]
    if not places:
        return spark.createDataFrame([], ENTRY)
    last = Window.partitionBy(*LANDED).orderBy(F.desc("number"))
    rows = spark.read.schema(ENTRY).parquet(*places)
    return rows.withColumn("_place", F.row_number().over(last)).filter("_place = 1").drop("_place")


def _next_number(spark: SparkSession, path: str) -> int:
    return 1 + max((int(name.split("-")[0]) for name in _entries(spark, path, whole=False)), default=0)


def _note(rows: DataFrame, path: str, number: int, landing: str) -> str:
    """Write an entry of the ledger; it counts from the moment its note is there."""
    name = f"{number:012d}-{landing}"
    place = f"{path.rstrip('/')}/{LEDGER}/{name}"
    rows.select(*[F.col(c.split()[0]) for c in ENTRY.split(", ")]).write.parquet(f"{place}/rows")
    write_text(rows.sparkSession, f"{place}/done", "")
    return name


def content(rows: DataFrame) -> DataFrame:
    """Number of rows and digest of every data set day.

    The digest covers all delivered values, nulls included, and the order of lines within each file, but neither names nor the
    order of files. The sum of hashes times places, less the first place times the sum of hashes, doesn't depend on where a
    batch begins to count, so one aggregation with partial sums is enough.
    """
    values = [c for c in rows.columns if c not in (*LANDED, *ORIGIN)]
    hashed = F.xxhash64(*values, *[F.col(c).isNull() for c in values])
    small, place = F.pmod(hashed, F.lit(1 << 30)).cast("decimal(10,0)"), F.coalesce("_arrival", F.lit(0)).cast("decimal(19,0)")
    files = (
        rows.withColumns({"_h": hashed.cast("decimal(20,0)"), "_s": small, "_w": (small * place).cast("decimal(28,0)"), "_p": place})
        .groupBy(*LANDED, "_file")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_h").alias("h"), F.sum("_w").alias("w"), F.sum("_s").alias("s"), F.min("_p").alias("p"))
    )
    order = (F.col("w") - (F.col("p") * F.col("s")).cast("decimal(38,0)")).cast("decimal(38,0)")
    file = F.xxhash64("n", F.col("h").cast("string"), order.cast("string")).cast("decimal(20,0)")
    digest = F.concat_ws("-", F.sum("n").cast("string"), F.sum(file).cast("string"))
    return files.groupBy(*LANDED).agg(F.sum("n").alias("row_count"), digest.alias("digest"))


def source_versions(files: DataFrame) -> DataFrame:
    """The version of every data set day's source files (LANDED, length, modified), from lengths and times of change alone."""
    one = F.xxhash64("length", F.unix_millis(F.col("modified"))).cast("decimal(20,0)")
    version = F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.sum(one).cast("string"))
    return files.groupBy(*LANDED).agg(version.alias("version"))


def changed_sources(versions: DataFrame, path: str) -> DataFrame:
    """The data set days whose source files are new or were touched since they were landed."""
    return versions.join(ledger(versions.sparkSession, path), [*LANDED, "version"], "left_anti")


# ---- landing ----------------------------------------------------------------------------------------------------------
def arranged(rows: DataFrame) -> DataFrame:
    """Rows by folder, a large folder split over several files; a reader of one data set skips the row groups of others."""
    return rows.hint("rebalance", *FOLDERS).sortWithinPartitions(*FOLDERS, "dataset", *ORIGIN)


def write_rows(rows: DataFrame, path: str, landing: str) -> None:
    """Append the rows of a landing. Nobody reads them before the ledger names the landing."""
    dealt = arranged(rows.withColumn("_landing", F.lit(landing)))
    dealt.write.partitionBy(*FOLDERS).mode("append").parquet(path)


def land_raw(rows: DataFrame, path: str, versions: DataFrame | None = None) -> Landing:
    """Land raw rows; an existing (feed, day, venue, data set) of other content is replaced, every other one stays.

    ``versions`` names the versions of the source files, see ``source_versions``. Rows that lack a part of their data set day
    can't be landed.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    new = stage(rows, "landing")
    found = content(new)
    found = found.join(versions, LANDED, "left") if versions is not None else found.withColumn("version", F.lit(None).cast("string"))
    found = stage(found, "landed-content")
    nameless = F.count_if(F.greatest(*[F.col(c).isNull() for c in LANDED]))
    span = found.agg(F.count(F.lit(1)).alias("n"), nameless.alias("nameless"), F.min("trading_day").alias("first"), F.max("trading_day").alias("last")).first()
    if span.nameless:
        raise ValueError("rows without feed, day, venue or data set can't be landed")
    if not span.n:
        return Landing(0, 0)
    number, landing = _next_number(spark, path), uuid.uuid4().hex
    held = ledger(spark, path).filter(F.col("trading_day").between(F.lit(span.first), F.lit(span.last)))
    held = held.select(*LANDED, F.col("landing").alias("_landing"), F.col("digest").alias("_digest"), F.col("version").alias("_version"))
    same = F.col("digest").eqNullSafe(F.col("_digest"))
    entries = stage(
        found.join(held, LANDED, "left")
        .filter(~same | ~F.coalesce("version", "_version").eqNullSafe(F.col("_version")))
        .select(*LANDED, "row_count", "digest", "version", F.when(same, F.col("_landing")).otherwise(F.lit(landing)).alias("landing"))
        .withColumn("number", F.lit(number).cast("bigint")),
        "landing-entries",
    )
    counts = entries.agg(F.count(F.lit(1)).alias("noted"), F.count_if(F.col("landing") == landing).alias("written")).first()
    if counts.written:
        fresh = new.join(entries.filter(F.col("landing") == landing).select(*LANDED), LANDED, "left_semi")
        write_rows(fresh.select(*new.columns), path, landing)
    if counts.noted:
        _note(entries, path, number, landing)
    return Landing(counts.written, span.n - counts.written)


def land_requested(
    requests: DataFrame, catalog: DataFrame, raw: DataFrame, spec: Feed, path: str, versions: DataFrame | None = None
) -> Landing:
    """Land the requested instrument-days, each data set by itself; unknown instruments are left out."""
    # A data set that several instruments name is landed once.
    few = few_requested(requests, catalog)
    wanted = requested_instruments(requests, catalog) if few is None else few
    rows = for_requests(raw, wanted.withColumn("instrument_id", F.lit(None).cast("string")), few is not None)
    return land_raw(landed_rows(rows, spec, F.col("venue"), F.col("file_day")), path, versions)


# ---- reading ----------------------------------------------------------------------------------------------------------
def _schema(spec: Feed) -> str:
    fields = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in spec.raw.fields])
    return f"{fields}, _file string, _arrival bigint, dataset string, _landing string, trading_day date, feed string, venue string"


def _between(first: dt.date | None, last: dt.date | None, day: dt.date) -> bool:
    return (first is None or first <= day) and (last is None or day <= last)


def _stored(spark: SparkSession, spec: Feed, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The rows of all landings of a feed, also those that nobody reads any more. Folders of other days aren't listed."""
    schema = spark.createDataFrame([], _schema(spec)).schema
    rows = replacement.read_table(spark, schema, path, lambda name: _between(first, last, dt.date.fromisoformat(name.split("=")[1])))
    return rows.filter(F.col("feed") == spec.tag)


def read_landed(
    spark: SparkSession, spec: Feed, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The rows of every data set day, of all days or a range, as it was landed last."""
    current = ledger(spark, path)
    if first is not None:
        current = current.filter(F.col("trading_day") >= F.lit(first))
    if last is not None:
        current = current.filter(F.col("trading_day") <= F.lit(last))
    current = current.select(*LANDED, F.col("landing").alias("_landing"))
    rows = _stored(spark, spec, path, first, last).join(current, [*LANDED, "_landing"], "left_semi")
    return rows.select(*spec.raw.names, *ORIGIN, "dataset", *VENUE_DAY)


def fold_landed(spark: SparkSession, spec: Feed, path: str) -> int:
    """Remove what nobody reads: rows of replaced data set days and of landings that broke off, and older ledger entries.

    Only days that hold such rows are rewritten, as a set of files (see ``replacement``). DataFrames read before a fold name files
    that it removes, so read anew after it. Returns the rows removed.
    """
    path = path.rstrip("/")
    replacement.settle(spark, path)
    current = ledger(spark, path)
    live = current.select(*LANDED, F.col("landing").alias("_landing"))
    stored = _stored(spark, spec, path)
    dead = stored.join(live, [*LANDED, "_landing"], "left_anti").groupBy("trading_day").count().collect()  # a row per day
    if dead:
        folders = [f"trading_day={row.trading_day}/feed={spec.tag}" for row in dead]
        old = [f"{folder}/{file}" for folder in folders for file in file_lengths(spark, f"{path}/{folder}")]
        name, data = replacement.new_data(path)
        kept = stored.filter(F.col("trading_day").isin([row.trading_day for row in dead])).join(live, [*LANDED, "_landing"], "left_semi")
        arranged(kept.select(*stored.columns)).write.partitionBy(*FOLDERS).parquet(data)
        replacement.finish(spark, replacement.decide(spark, path, name, old, 0))
    before, whole = _entries(spark, path, whole=False), _entries(spark, path)
    if len(before) > 1 or before != whole:
        kept_name = _note(stage(current, "ledger"), path, _next_number(spark, path), "fold") if whole else None
        for name in before:
            if name != kept_name:
                delete_folder(spark, f"{path}/{LEDGER}/{name}")
    return sum(row["count"] for row in dead)


def export_text(rows: DataFrame, path: str) -> None:
    """Write raw rows as gzip text with a header, just the delivered columns; exported venue-days are replaced as a whole."""
    writer = _write_folders(rows.drop(*ORIGIN, "dataset"), VENUE_DAY)
    writer.option("header", True).option("compression", "gzip").csv(path)


def _write_folders(rows: DataFrame, folders: list[str]) -> DataFrameWriter:
    dealt = rows.hint("rebalance", *[F.col(c) for c in folders])
    return dealt.write.partitionBy(*folders).option("partitionOverwriteMode", "dynamic").mode("overwrite")
