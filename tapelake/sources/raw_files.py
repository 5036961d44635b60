"""Raw files: gzip CSV per data set and day, JSON instrument lists, and the cache tree that holds them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions.locations import cached_parts, delivered_parts, parse_cache_location
from tapelake.functions.times import date_mode
from tapelake.plans.staging import existing_paths, path_exists
from tapelake.schemas import INSTRUMENTS_RAW, LEVELS, TRADES, Feed


def csv_options(malformed: str = "FAILFAST") -> dict[str, str]:
    """CSV options shared by batch and stream reads.

    The header must name the expected columns. A value that does not parse fails the job; an empty one is null.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "mode": malformed,
        "recursiveFileLookup": "true",
    }


def read_raw(
    spark: SparkSession,
    spec: Feed,
    path: str | list[str],
    name_glob: str | None = None,
    malformed: str = "FAILFAST",
    check: bool = True,
) -> DataFrame:
    """Raw rows plus ``_file`` and ``_arrival``.

    A gzip file is read by one task from top to bottom, so ``_arrival`` follows the line order within a file. A path that
    does not exist gives no rows; with ``check=False`` the paths are known to exist.
    """
    reader = spark.read.schema(spec.raw).options(**csv_options(malformed))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    extra = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_arrival", T.LongType())])
    paths = [p for p in ([path] if isinstance(path, str) else path) if not check or path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], T.StructType([*spec.raw.fields, *extra.fields]))
    return reader.csv(paths).select(
        *spec.raw.names, F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_arrival")
    )


def read_trades(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_raw(spark, TRADES, path, **options)


def read_level_updates(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_raw(spark, LEVELS, path, **options)


def read_instruments(spark: SparkSession, path: str | list[str], exchange: str) -> DataFrame:
    """Elements of JSON arrays (one array per file) with the exchange the caller asked for; null elements are skipped."""
    elements = F.from_json("value", T.ArrayType(INSTRUMENTS_RAW), {"mode": "FAILFAST"})
    rows = spark.read.text(path, wholetext=True).select(F.explode(elements).alias("element"))
    return rows.filter(F.col("element").isNotNull()).select("element.*").withColumn("exchange", F.lit(exchange))


def cache_glob(spec: Feed, first: dt.date, last: dt.date) -> str:
    """File names of one feed for the months of a range of days."""
    days = (first + dt.timedelta(days=i) for i in range((last - first).days + 1))
    dates = sorted({f"{day:%Y-%m}-??" for day in days})
    return f"*_{{{','.join(dates)}}}_{spec.tag}.csv.gz"


def scan_cache(
    spark: SparkSession,
    root: str,
    slug: str,
    instrument_type: str,
    spec: Feed,
    date: dt.date | str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    **options,
) -> DataFrame:
    """Raw rows of all cached files of one feed below ``<root>/<slug>/<type>``, with the parts of their location."""
    first, last = date_mode(date, start, end)
    folder = f"{root.rstrip('/')}/{slug}/{instrument_type}"
    rows = read_raw(spark, spec, folder, name_glob=cache_glob(spec, first, last), **options)
    rows = rows.withColumns(cached_parts(F.col("_file")))
    return rows.filter(F.col("file_day").between(F.lit(first), F.lit(last)))


def list_cache(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and location parts of the files below ``root``. Contents are not read, empty files are not listed."""
    if path_exists(spark, root):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    else:
        files = spark.createDataFrame([], "path string, length bigint")
    return files.withColumns(parse_cache_location(F.col("path"), root.split(":", 1)[-1]))


def list_delivered(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Path, size, time of change, slug, data set and day of the delivered files in some day folders (patterns); contents are not
    read."""
    found = [path for pattern in folders for path in existing_paths(spark, pattern)]
    if found:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").load(found)
        files = files.select("path", "length", F.col("modificationTime").alias("modified"))
    else:
        files = spark.createDataFrame([], "path string, length bigint, modified timestamp")
    return files.withColumns(delivered_parts(F.col("path")))


def filled_files(listing: DataFrame) -> DataFrame:
    """Files that count as cached: the non-empty ones."""
    return listing.filter(F.col("length") > 0)


def skipped_files(listing: DataFrame, dataset_map: DataFrame) -> DataFrame:
    """Files whose folder names no known data set; the import leaves them out."""
    return listing.join(dataset_map, "dataset", "left_anti")


def feed_list(feeds: Iterable[str]) -> list[str]:
    """The requested file tags, each once, in the order given."""
    known = {spec.tag for spec in (TRADES, LEVELS)}
    tags = list(dict.fromkeys(tag.strip().lower() for tag in feeds))
    if not tags or not set(tags) <= known:
        raise ValueError(f"feeds must be some of {sorted(known)}, got {tags}")
    return tags


def page(rows: DataFrame, count: int, skip: int = 0, *order: str) -> DataFrame:
    """``count`` rows after the first ``skip``, in source order (or by the given columns).

    This sorts for one page and gathers what is before it; who turns many pages, or deep ones, indexes the rows first
    (``operators/pages.py``).
    """
    return rows.orderBy(*(order or ("_file", "_arrival"))).offset(skip).limit(count)


def page_file(spark: SparkSession, spec: Feed, path: str, count: int, skip: int = 0) -> DataFrame:
    """A page of one raw file.

    One task reads a gzip file from its top, so ``_arrival`` is the number of the line: only the wanted lines leave the task,
    and it stops at the last of them. Other files may be split over tasks; their lines are put in order first.
    """
    rows = read_raw(spark, spec, path)
    if not path.endswith(".gz"):
        return page(rows, count, skip)
    return rows.filter(F.col("_arrival") >= skip).limit(count)
