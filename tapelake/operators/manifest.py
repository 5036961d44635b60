"""What should be fetched, what is cached already, and how a run went."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.locations import cache_location, feed_segment, source_location
from tapelake.functions.times import date_mode, days_between, iso_day
from tapelake.functions.venues import first_filled
from tapelake.sources.raw_files import feed_list, filled_files


def listed_dataset() -> Column:
    """The data set id of an instrument-list row: its own id, else its symbol, without outer blanks."""
    own = first_filled(F.col("datasetId"), F.col("dataset"), F.col("dataset_id"))
    symbol = first_filled(F.col("symbol"), F.col("symbolId"), F.col("symbol_id"), F.col("id"))
    return F.nullif(F.trim(F.coalesce(own, symbol)), F.lit(""))


def listed_symbol() -> Column:
    """The symbol used in file names, lower-case; ``unknown`` if there is none."""
    symbol = first_filled(*[F.col(c) for c in ("symbol", "symbolId", "symbol_id", "id", "datasetId", "dataset")])
    return F.coalesce(F.lower(F.trim(symbol)), F.lit("unknown"))


def listed_instruments(raw: DataFrame) -> DataFrame:
    """Instrument-list rows to data set, symbol, type and availability days; rows without a data set are dropped."""
    return raw.select(
        listed_dataset().alias("dataset"),
        listed_symbol().alias("symbol"),
        F.lower(F.trim(F.coalesce(first_filled(F.col("type"), F.col("instrumentType")), F.lit("")))).alias(
            "instrument_type"
        ),
        iso_day(first_filled(F.col("availableSince"), F.col("available_from"))).alias("since"),
        iso_day(first_filled(F.col("availableTo"), F.col("available_to"))).alias("to"),
        "exchange",
    ).filter(F.col("dataset").isNotNull())


def download_manifest(
    listed: DataFrame,
    slug: Column,
    feeds: Iterable[str] = ("trades", "l2"),
    date: dt.date | str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """One row per instrument, available day and feed, with source and cache location.

    ``listed`` has dataset, symbol, instrument_type, since and to. Each instrument's days are the requested range cut to
    [since, to), generated from its own row: no product with a calendar is formed and thinned out again.
    """
    first, last = date_mode(date, start, end)
    from_day = F.greatest(F.lit(first), F.col("since"))
    to_day = F.least(F.lit(last), F.date_sub(F.col("to"), 1))
    tags = F.array(*[F.lit(tag) for tag in feed_list(feeds)])
    wanted = (
        listed.withColumn("slug", slug)
        .withColumn("trading_day", F.explode(days_between(from_day, to_day)))
        .withColumn("tag", F.explode(tags))
    )
    day, tag = F.col("trading_day"), F.col("tag")
    source = source_location(F.col("slug"), feed_segment(tag), day, F.col("dataset"))
    cache = cache_location(F.col("slug"), F.col("instrument_type"), F.col("dataset"), F.col("symbol"), day, tag)
    return wanted.select(
        "dataset", "instrument_type", "trading_day", "tag", source.alias("source"), cache.alias("cache")
    )


def remaining(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows whose file is not there, or is there but empty. ``listing`` has ``cache`` and ``length``."""
    return manifest.join(filled_files(listing).select("cache"), "cache", "left_anti").select(*manifest.columns)


def outcome_summary(results: DataFrame) -> DataFrame:
    """Done, saved, missing and failed downloads per day, and in total (``trading_day`` null).

    ``results`` has trading_day, path and error; saved means a path and no error, missing means error ``404``.
    """
    saved = F.col("path").isNotNull() & F.col("error").isNull()
    missing = ~saved & F.coalesce(F.col("error") == "404", F.lit(False))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return results.rollup("trading_day").agg(
        F.count(F.lit(1)).alias("done"),
        total(saved).alias("saved"),
        total(missing).alias("missing"),
        total(~saved & ~missing).alias("failed"),
    )
