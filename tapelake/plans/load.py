"""Idempotent loads into the fact tables.

Parquet has no unique index and no transaction, so a load stages its batch once, checks all of it, leaves out the keys the
touched days already hold, and makes one append. A load that fails leaves the table as it was; a load that is repeated
inserts nothing, also after a driver was lost while committing. One writer per feed and day is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.times import yesterday
from tapelake.functions.venues import exchange_slug
from tapelake.operators import dedup
from tapelake.operators.catalog import available_on
from tapelake.operators.layout import BUCKETS, check_buckets, instrument_bucket, write_layout
from tapelake.operators.normalize import normalize_levels, normalize_trades, sequence_arrival, sequence_sorted
from tapelake.operators.sequence import continue_sequence
from tapelake.operators.validate import check_facts, rejected, valid
from tapelake.plans import summaries
from tapelake.plans.staging import stage
from tapelake.schemas import IDENTITY, LEVELS, TRADES, Feed
from tapelake.sources.facts import read_feed_days


class LoadRejected(ValueError):
    """The batch breaks a constraint; nothing was written."""


@dataclass
class LoadReport:
    """What a load did. ``rejects`` holds the rows left out for a reason, staged, with that reason.

    A load by request also tells the requests whose instrument the catalog lacks (``unknown``), and the wanted instrument-days
    without a source file (``absent``, staged; ``expected`` says that the instrument was available that day).
    """

    received: int = 0
    inserted: int = 0
    rejected: int = 0
    reasons: dict[str, int] = field(default_factory=dict)
    days: list[dt.date] = field(default_factory=list)
    rejects: DataFrame | None = None
    unknown: int = 0
    absent_expected: int = 0
    absent: DataFrame | None = None

    @property
    def skipped(self) -> int:
        """Valid rows whose key was there already."""
        return self.received - self.rejected - self.inserted


def _target(spark: SparkSession, spec: Feed, path: str, days: list[dt.date], buckets: list[int] | None = None) -> DataFrame:
    """What the table holds for some days, in some of its buckets."""
    rows = read_feed_days(spark, spec, path, set(days).__contains__)
    return rows if buckets is None else rows.filter(F.col("instr_bucket").isin(buckets))


def _load(
    batch: DataFrame,
    spec: Feed,
    path: str,
    choose: Callable[[DataFrame, DataFrame], DataFrame],
    catalog: DataFrame | None,
    on_invalid: str,
    buckets: int,
    staged: bool = False,
) -> LoadReport:
    spark = batch.sparkSession
    check_buckets(spark, path, buckets)  # the note is written with the first rows, after all checks
    if catalog is None:  # what the checks say is staged with the rows, so that counting it reads no values
        checked = check_facts(batch.select(*spec.columns), spec)
        checked = checked if staged else stage(checked, f"load-{spec.tag}")
    else:
        rows = batch.select(*spec.columns)
        checked = check_facts(rows if staged else stage(rows, f"load-{spec.tag}"), spec, catalog)
    # One row per (day, bucket, reason): bounded by the calendar and the layout, not by the data.
    bucket = instrument_bucket(F.col("instrument_id"), buckets).alias("bucket")
    summary = checked.groupBy("trading_day", bucket, "reason").agg(F.count(F.lit(1)).alias("n")).collect()
    report = LoadReport(received=sum(r.n for r in summary))
    for row in summary:
        if row.reason is not None:
            report.rejected += row.n
            report.reasons[row.reason] = report.reasons.get(row.reason, 0) + row.n
    report.days = sorted({r.trading_day for r in summary if r.reason is None})
    report.rejects = rejected(checked)
    if report.rejected and on_invalid == "fail":
        raise LoadRejected(f"{report.rejected} of {report.received} rows rejected: {report.reasons}")
    if not report.days:
        return report
    pairs: dict[dt.date, set[int]] = {}
    for r in summary:
        if r.reason is None:
            pairs.setdefault(r.trading_day, set()).add(r.bucket)
    target = _target(spark, spec, path, report.days, sorted(set().union(*pairs.values())))
    fresh = choose(valid(checked), target)
    written = Observation(f"written-{uuid.uuid4().hex}")
    sound, new = summaries.kept_days(spark, path), set(report.days) - summaries.table_days(spark, path)
    summaries.mark(spark, path, report.days)
    write_layout(fresh, path, buckets, observe=(written, F.count(F.lit(1)).alias("rows")))
    report.inserted = written.get["rows"]
    if report.inserted:
        summaries.refresh(spark, spec, path, pairs, sound)
    else:
        summaries.unmark(spark, path, (sound | new) & set(report.days))
    return report


def _keep_first(keys: list[str], order: list[str | Column]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda batch, target: dedup.new_rows(batch, target, keys, order)


def append_feed(
    batch: DataFrame,
    spec: Feed,
    path: str,
    catalog: DataFrame | None = None,
    on_invalid: str = "fail",
    buckets: int = BUCKETS,
    staged: bool = False,
) -> LoadReport:
    """Keep-first insert on (instrument, ts, ordinal). Rows already stored win; of duplicates in the batch one remains.

    ``on_invalid="fail"`` rejects the whole batch for one bad row; ``"reject"`` loads the good rows and reports the others.
    ``staged`` says that the batch is little more than a read of staged rows, which needn't be written once more.
    """
    return _load(batch, spec, path, _keep_first(spec.key, spec.rest), catalog, on_invalid, buckets, staged)


def append_trades(batch: DataFrame, path: str, **options) -> LoadReport:
    return append_feed(batch, TRADES, path, **options)


def append_level_updates(batch: DataFrame, path: str, **options) -> LoadReport:
    return append_feed(batch, LEVELS, path, **options)


def merge_feed_by_day(
    batch: DataFrame,
    spec: Feed,
    path: str,
    catalog: DataFrame | None = None,
    on_invalid: str = "fail",
    buckets: int = BUCKETS,
) -> LoadReport:
    """Keep-first insert on (instrument, trading day, ordinal): the earliest row of a day key, if the day lacks that key."""
    return _load(batch, spec, path, _keep_first(spec.day_key, ["ts", *spec.rest]), catalog, on_invalid, buckets)


def merge_trades_by_day(batch: DataFrame, path: str, **options) -> LoadReport:
    return merge_feed_by_day(batch, TRADES, path, **options)


def merge_level_updates_by_day(batch: DataFrame, path: str, **options) -> LoadReport:
    return merge_feed_by_day(batch, LEVELS, path, **options)


def append_strict(
    batch: DataFrame,
    spec: Feed,
    path: str,
    catalog: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> LoadReport:
    """Insert without any conflict rule: a key that is repeated or already stored fails the load."""

    def choose(rows: DataFrame, target: DataFrame) -> DataFrame:
        conflicts = dedup.conflicting_keys(rows, target, spec.key).count()
        if conflicts:
            raise LoadRejected(f"{conflicts} keys are repeated or stored already")
        return rows

    return _load(batch, spec, path, choose, catalog, "fail", buckets)


# ---- loads by request -------------------------------------------------------------------------------------------------
def requested_instruments(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog rows and days of the requests, which name an instrument by id or by identity.

    A request without a day means yesterday. Requests for an unknown instrument are left out (see ``unknown_requests``). A
    known instrument without a data set fails the job.
    """
    key = ["instrument_id"] if "instrument_id" in requests.columns else IDENTITY
    day = F.coalesce("trading_day", yesterday()) if "trading_day" in requests.columns else yesterday()
    # Spark takes requests that were made from a small table, a row per day, for as small as that table; so the catalog is hashed.
    found = requests.select(*key, day.alias("trading_day")).distinct().join(catalog.hint("shuffle_hash"), key)
    missing = F.col("dataset").isNull() | (F.col("dataset") == "")
    dataset = F.when(missing, F.raise_error(F.lit("instrument has no data set"))).otherwise(F.col("dataset"))
    return found.select("instrument_id", *IDENTITY, dataset.alias("dataset"), "trading_day")


def unknown_requests(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    key = ["instrument_id"] if "instrument_id" in requests.columns else IDENTITY
    return requests.join(catalog.select(*key), key, "left_anti")


class FilesMissing(ValueError):
    """Source files of days on which their instruments were available are not there; nothing was written."""


def source_gaps(wanted: DataFrame, files: DataFrame, catalog: DataFrame) -> DataFrame:
    """Wanted instrument-days without a file: instrument_id, dataset, trading_day, expected.

    ``files`` names slug, upper-cased data set and day of what was delivered. A file is expected on days in [available since,
    expiration); outside of them its absence is a day without data.
    """
    named = wanted.withColumn("slug", exchange_slug(F.col("exchange"))).withColumn("_name", F.upper("dataset"))
    there = files.select("slug", F.col("dataset").alias("_name"), F.col("file_day").alias("trading_day")).distinct()
    gaps = named.join(there, ["slug", "_name", "trading_day"], "left_anti")
    spans = catalog.select("instrument_id", F.to_date("available_since").alias("_since"), F.to_date("expiration").alias("_to"))
    expected = available_on(F.col("trading_day"), F.col("_since"), F.col("_to"))
    return gaps.join(spans, "instrument_id").select("instrument_id", "dataset", "trading_day", expected.alias("expected"))


# Requested instrument-days that a join side may be broadcast for.
FEW_REQUESTED = 100_000


def few_requested(requests: DataFrame, catalog: DataFrame) -> DataFrame | None:
    """``requested_instruments``, staged, if there are few; none if they are many."""
    if requests.limit(FEW_REQUESTED + 1).count() > FEW_REQUESTED:
        return None
    wanted = stage(requested_instruments(requests, catalog), "requested")
    return wanted if wanted.limit(FEW_REQUESTED + 1).count() <= FEW_REQUESTED else None


def _requested_days(wanted: DataFrame) -> DataFrame:
    return wanted.select(
        exchange_slug(F.col("exchange")).alias("slug"),
        F.upper("dataset").alias("dataset"),
        F.col("trading_day").alias("file_day"),
        "instrument_id",
        F.col("exchange").alias("venue"),
    ).distinct()


def _day_key(raw: DataFrame) -> list[str]:
    return [c for c in ("slug", "dataset", "file_day") if c in raw.columns]


def for_requests(raw: DataFrame, wanted: DataFrame, few: bool = False) -> DataFrame:
    """Raw rows (with dataset and file_day) of the wanted data sets and days, with instrument id and exchange.

    Where the rows know the slug of their exchange it must agree too: two exchanges may use one data set name. If the wanted days were
    counted and are ``few``, they are broadcast and no raw row is shuffled.
    """
    days = _requested_days(wanted)
    return raw.drop("venue").join(F.broadcast(days) if few else days, _day_key(raw))


def requested_rows(requests: DataFrame, catalog: DataFrame, raw: DataFrame) -> DataFrame:
    few = few_requested(requests, catalog)
    return for_requests(raw, requested_instruments(requests, catalog) if few is None else few, few is not None)


def load_trades(
    requests: DataFrame, catalog: DataFrame, raw: DataFrame, path: str, side_coding: str = "service", **options
) -> LoadReport:
    """Load the requested instrument-days of trades from raw rows."""
    rows = requested_rows(requests, catalog, raw)
    return append_trades(normalize_trades(rows, side_coding), path, **options)


def load_level_updates(
    requests: DataFrame,
    catalog: DataFrame,
    raw: DataFrame,
    path: str,
    side_coding: str = "service",
    sequence: str = "arrival",
    source: list[str] | None = None,
    unique: bool = False,
    **options,
) -> LoadReport:
    """Load the requested instrument-days of level updates from raw rows, numbered per source file.

    ``unique`` says that no two rows of a source have one ``_arrival``, which holds for what one read gives.
    """
    few = few_requested(requests, catalog)
    rows = for_requests(raw, requested_instruments(requests, catalog) if few is None else few, few is not None)
    # Two instruments of one data set each get its rows, so that an arrival occurs twice.
    single = unique and few is not None and dedup.repeated_keys(_requested_days(few), _day_key(raw)).isEmpty()
    numbered = numbered_levels(rows, sequence, source or ["_file"], single)
    return append_level_updates(normalize_levels(numbered, side_coding), path, **options)


def numbered_levels(raw: DataFrame, sequence: str, source: list[str], unique: bool = False) -> DataFrame:
    """Raw level updates with ``update_seq``: in arrival order from 0, or in sorted order from 1, per source. ``unique`` says that no two
    rows of a source have one arrival."""
    if sequence not in ("arrival", "sorted"):
        raise ValueError(f"unknown sequence: {sequence}")
    # Numbering reads its input more than once; raw text should be parsed only once.
    staged = stage(raw, "raw-levels")
    numbered = sequence_arrival(staged, source, unique=unique) if sequence == "arrival" else sequence_sorted(staged, source)
    return numbered.withColumn("update_seq", F.col("update_seq").cast("int"))


def continued_levels(spark: SparkSession, batch: DataFrame, path: str) -> DataFrame:
    """Normalized 0-based level updates whose numbers go on after the highest one stored for (instrument, day)."""
    days = [r.trading_day for r in batch.select("trading_day").distinct().collect()]
    target = _target(spark, LEVELS, path, days)
    shifted = continue_sequence(batch, target, ["instrument_id", "trading_day"])
    return shifted.withColumn("update_seq", F.col("update_seq").cast("int"))
