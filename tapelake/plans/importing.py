"""Offline import: all cached files of an exchange, type and range of days in one job per feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.venues import exchange_slug
from tapelake.operators.layout import BUCKETS, stored_buckets
from tapelake.operators.normalize import normalize_levels, normalize_trades
from tapelake.plans.load import LoadReport, append_feed, append_strict, numbered_levels
from tapelake.schemas import LEVELS, TRADES, Feed
from tapelake.sources.facts import dataset_map
from tapelake.sources.raw_files import list_cache, scan_cache, skipped_files


def slug_of(spark: SparkSession, exchange: str, style: str = "import") -> str:
    return spark.range(1).select(exchange_slug(F.lit(exchange), style)).first()[0]


def imported_rows(raw: DataFrame, names: DataFrame, spec: Feed, side_coding: str, sequence: str) -> DataFrame:
    """Normalized rows of cached files; files of unknown data sets are left out by the join."""
    known = raw.join(names, "dataset")
    if spec is TRADES:
        return normalize_trades(known, side_coding)
    return normalize_levels(numbered_levels(known, sequence, ["_file"]), side_coding)


def import_cache(
    spark: SparkSession,
    root: str,
    catalog: DataFrame,
    exchange: str,
    instrument_type: str,
    tables: dict[str, str],
    date: dt.date | str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    side_coding: str = "service",
    sequence: str = "sorted",
    strict: bool = False,
    on_invalid: str = "fail",
    buckets: int = BUCKETS,
    slug_style: str = "import",
) -> dict[str, LoadReport]:
    """Import both feeds into ``tables`` (feed name to path).

    ``strict`` has no conflict rule, so that importing a file twice fails; otherwise it inserts nothing. ``buckets`` counts for
    new tables; others keep theirs.
    """
    names = dataset_map(catalog, exchange, instrument_type)
    slug = slug_of(spark, exchange, slug_style)
    reports = {}
    for spec in (TRADES, LEVELS):
        raw = scan_cache(spark, root, slug, instrument_type, spec, date, start, end)
        rows = imported_rows(raw, names, spec, side_coding, sequence)
        path = tables[spec.name]
        held = stored_buckets(spark, path) or buckets
        if strict:
            reports[spec.name] = append_strict(rows, spec, path, buckets=held)
        else:
            reports[spec.name] = append_feed(rows, spec, path, on_invalid=on_invalid, buckets=held)
    return reports


def import_skips(spark: SparkSession, root: str, catalog: DataFrame, exchange: str, instrument_type: str) -> DataFrame:
    """Cached files that an import would skip because their folder names no known data set."""
    listing = list_cache(spark, f"{root.rstrip('/')}/{slug_of(spark, exchange)}/{instrument_type}")
    return skipped_files(listing.filter(F.col("tag").isNotNull()), dataset_map(catalog, exchange, instrument_type))
