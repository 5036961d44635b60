"""Coverage of the fact tables: what is there, how much, and what is missing.

A *request* names an instrument (identity columns), a feed and a day. Facts are reduced to one row per instrument and day
before they meet requests or catalog, so a hot instrument never crosses a shuffle row by row.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.times import as_day, days_between
from tapelake.operators.layout import bucket_filter, instrument_bucket
from tapelake.schemas import FEEDS, IDENTITY
from tapelake.sources.facts import in_days

FEED_DAY = ["feed", "instrument_id", "trading_day"]
MEASURES = ["items_count", "first_ts", "last_ts"]


def feed_days(facts: DataFrame, feed: str) -> DataFrame:
    """Count, first and last time per instrument and day. A day without rows has no row."""
    return (
        facts.groupBy("instrument_id", "trading_day")
        .agg(
            F.count(F.lit(1)).alias("items_count"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .withColumn("feed", F.lit(feed))
    )


def present_days(facts: DataFrame, feed: str) -> DataFrame:
    """The days each instrument has rows on."""
    return facts.select(F.lit(feed).alias("feed"), "instrument_id", "trading_day").distinct()


def both_feeds(per_feed: dict[str, DataFrame]) -> DataFrame:
    """Stack per-feed tables; feeds other than the two with data are ignored."""
    frames = [df for feed, df in per_feed.items() if feed in FEEDS]
    stacked = frames[0]
    for df in frames[1:]:
        stacked = stacked.unionByName(df)
    return stacked


def resolve(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requests with their ``instrument_id``, null for an unknown identity.

    Either side may be far larger than Spark takes it for, so neither is broadcast: each task hashes its part of the catalog.
    """
    return requests.join(catalog.select(*IDENTITY, "instrument_id").hint("shuffle_hash"), IDENTITY, "left")


@dataclass(frozen=True)
class Scope:
    """What some requests can touch: how many they are, their range of days, their supported feeds, their days."""

    requests: int
    first: dt.date | None
    last: dt.date | None
    feeds: frozenset[str]
    days: frozenset[dt.date] = frozenset()


def scope_of(requests: DataFrame) -> Scope:
    """One pass over the requests; the result is bounded by the calendar."""
    day = F.col("trading_day") if "trading_day" in requests.columns else F.lit(None).cast("date")
    supported = F.when(F.col("feed").isin(list(FEEDS)), F.col("feed"))
    row = requests.agg(F.count(F.lit(1)), F.min(day), F.max(day), F.collect_set(supported), F.collect_set(day)).first()
    return Scope(row[0], row[1], row[2], frozenset(row[3]), frozenset(row[4]))


def requested_pairs(requests: DataFrame, catalog: DataFrame, buckets: int) -> dict[dt.date, set[int]]:
    """The (day, bucket) pairs that requests of known instruments touch: bounded by the calendar and the layout."""
    found = resolve(requests, catalog).filter(F.col("instrument_id").isNotNull() & F.col("trading_day").isNotNull())
    number = instrument_bucket(F.col("instrument_id"), buckets).alias("bucket")
    days = found.select("trading_day", number).groupBy("trading_day").agg(F.collect_set("bucket").alias("buckets")).collect()
    return {row.trading_day: set(row.buckets) for row in days}


def _narrowed(
    requests: DataFrame,
    scope: Scope,
    catalog: DataFrame,
    facts: dict[str, DataFrame],
    days: tuple[dt.date, dt.date],
    buckets: dict[str, int | None] | None,
) -> dict[str, DataFrame]:
    """The facts that can matter to some requests: their feeds, range of days, and the buckets of their instruments.

    All of it becomes literal filters, so other tables and partitions are not read. Any number of requests makes the same
    plan: what is collected is a list of bucket numbers, at most as many as the table has.
    """
    rows = {feed: in_days(df, *days) for feed, df in facts.items() if feed in scope.feeds}
    for feed, df in rows.items():
        count = (buckets or {}).get(feed)
        if count and "instr_bucket" in df.columns:
            found = resolve(requests, catalog).filter(F.col("instrument_id").isNotNull())
            numbers = found.select(instrument_bucket(F.col("instrument_id"), count)).distinct().collect()
            rows[feed] = df.filter(F.col("instr_bucket").isin([r[0] for r in numbers]))
    return rows


def of_instruments(df: DataFrame, ids: list, buckets: int | None = None) -> DataFrame:
    """Rows of some instruments; with the number of ``buckets`` of a stored table, from their buckets only."""
    rows = df.filter(F.col("instrument_id").isin(ids))
    return rows.filter(bucket_filter(ids, buckets)) if buckets and "instr_bucket" in df.columns else rows


def feed_day_info(
    requests: DataFrame,
    catalog: DataFrame,
    facts: dict[str, DataFrame],
    buckets: dict[str, int | None] | None = None,
    scope: Scope | None = None,
) -> DataFrame:
    """``items_count``, ``first_ts`` and ``last_ts`` of every requested feed-day that has rows.

    Requests with an unknown instrument, an unsupported feed or an empty day give no row.
    """
    scope = scope or scope_of(requests)
    rows = _narrowed(requests, scope, catalog, facts, (scope.first, scope.last), buckets) if scope.first else {}
    if not rows:
        return info_of_days(requests, catalog, {feed: feed_days(df, feed).limit(0) for feed, df in facts.items()})
    return info_of_days(requests, catalog, {feed: feed_days(df, feed) for feed, df in rows.items()})


def info_of_days(requests: DataFrame, catalog: DataFrame, days: dict[str, DataFrame]) -> DataFrame:
    """``feed_day_info`` from a row per instrument and day of each feed, as summaries hold them."""
    wanted = resolve(requests.filter(F.col("feed").isin(list(days))), catalog).filter(F.col("instrument_id").isNotNull())
    found = both_feeds({feed: df.select(*FEED_DAY, *MEASURES) for feed, df in days.items()})
    return wanted.join(found, FEED_DAY).select(*IDENTITY, *FEED_DAY, *MEASURES)


def feed_day_info_one(
    catalog: DataFrame,
    facts: dict[str, DataFrame],
    identity: Column,
    feed: str,
    day: dt.date | str,
    buckets: int | None = None,
) -> DataFrame:
    """One feed-day. The identity is unique, so its id becomes a literal filter that the scan can use."""
    spark = catalog.sparkSession
    found = [r.instrument_id for r in catalog.filter(identity).select("instrument_id").limit(1).collect()]
    if feed not in facts or feed not in FEEDS or not found:
        return spark.createDataFrame([], "items_count bigint, first_ts timestamp, last_ts timestamp")
    rows = of_instruments(in_days(facts[feed], day), found, buckets)
    return feed_days(rows, feed).select("items_count", "first_ts", "last_ts")


def exists_feed_on_day(
    requests: DataFrame,
    catalog: DataFrame,
    facts: dict[str, DataFrame],
    buckets: dict[str, int | None] | None = None,
    scope: Scope | None = None,
) -> DataFrame:
    """Every request with ``has_data``; false for an unknown instrument and for an unsupported feed."""
    scope = scope or scope_of(requests)
    rows = _narrowed(requests, scope, catalog, facts, (scope.first, scope.last), buckets) if scope.first else {}
    if not rows:
        return requests.withColumn("has_data", F.lit(False))
    return exists_in_days(requests, catalog, {feed: present_days(df, feed) for feed, df in rows.items()})


def exists_in_days(requests: DataFrame, catalog: DataFrame, days: dict[str, DataFrame]) -> DataFrame:
    """``exists_feed_on_day`` from a row per instrument and day of each feed."""
    present = both_feeds({feed: df.select(*FEED_DAY) for feed, df in days.items()})
    return (
        resolve(requests, catalog)
        .join(present.withColumn("_present", F.lit(True)), FEED_DAY, "left")
        .select(*requests.columns, F.coalesce("_present", F.lit(False)).alias("has_data"))
    )


def calendar(start: Column, end: Column) -> Column:
    """One row per day from start to end, both included (a generator for ``select``)."""
    return F.explode(days_between(start, end))


def missing_days(
    requests: DataFrame,
    catalog: DataFrame,
    facts: dict[str, DataFrame],
    start: dt.date | str | None = None,
    as_of: dt.date | str | None = None,
    buckets: dict[str, int | None] | None = None,
    scope: Scope | None = None,
) -> DataFrame:
    """Days from ``start`` through ``as_of`` (default: today, UTC) on which a requested feed has no rows.

    Without ``start`` every request starts at its own ``trading_day``. An unknown instrument and an unsupported feed miss
    every day. Facts before the first start cannot matter and are not scanned.
    """
    last = as_day(as_of or dt.datetime.now(dt.timezone.utc).date())
    scope = scope or scope_of(requests)
    first = (scope.first or last) if start is None else as_day(start)
    rows = _narrowed(requests, scope, catalog, facts, (first, last), buckets) if first <= last else {}
    return missing_in_days(requests, catalog, {feed: present_days(df, feed) for feed, df in rows.items()}, start, last)


def missing_in_days(
    requests: DataFrame, catalog: DataFrame, days: dict[str, DataFrame], start: dt.date | str | None, last: dt.date
) -> DataFrame:
    """``missing_days`` from a row per instrument and day of each feed."""
    if start is None:
        starts = requests.withColumnRenamed("trading_day", "_start")
    else:
        starts = requests.drop("trading_day").withColumn("_start", F.lit(as_day(start)))
    columns = [*IDENTITY, "feed", "trading_day"]
    wanted = resolve(starts, catalog).withColumn("trading_day", calendar(F.col("_start"), F.lit(last)))
    if not days:
        return wanted.select(*columns)
    present = both_feeds({feed: df.select(*FEED_DAY) for feed, df in days.items()})
    return wanted.join(present, FEED_DAY, "left_anti").select(*columns)


def in_day_order(missing: DataFrame) -> DataFrame:
    """Missing days ascending within each request."""
    return missing.orderBy(*IDENTITY, "feed", "trading_day")


def feed_counts(facts: dict[str, DataFrame]) -> DataFrame:
    """Rows and days per feed, over both feeds at once."""
    stacked = both_feeds({f: df.select(F.lit(f).alias("feed"), "trading_day") for f, df in facts.items()})
    return stacked.groupBy("feed", "trading_day").agg(F.count(F.lit(1)).alias("items_count"))
