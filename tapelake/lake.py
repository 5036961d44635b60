"""One object for the questions and commands of a lake: tables at fixed places, one method per task."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.locations import delivered_parts, source_location
from tapelake.functions.times import as_day
from tapelake.functions.venues import exchange_slug
from tapelake.operators import catalog as catalog_ops
from tapelake.operators import coverage, manifest
from tapelake.operators.layout import BUCKETS, stored_buckets
from tapelake.plans import importing, landing, load, maintenance, refresh, summaries
from tapelake.plans.staging import stage
from tapelake.schemas import FEEDS, IDENTITY, LEVELS, TRADES, Feed
from tapelake.session import configure
from tapelake.sources import facts, raw_files


@dataclass
class Lake:
    """``root`` holds the tables; ``source`` holds delivered files as ``v1/<slug>/<feed>/<yyyy>/<mm>/<dd>/<dataset>.csv.gz``.

    ``buckets`` counts for new tables; a table keeps the number it was written with.
    """

    spark: SparkSession
    root: str
    source: str
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        configure(self.spark)

    # ---- places ---------------------------------------------------------------------------------------------------
    def table(self, spec: Feed) -> str:
        return f"{self.root.rstrip('/')}/{'trades' if spec is TRADES else 'level_updates'}"

    @property
    def catalog_path(self) -> str:
        return f"{self.root.rstrip('/')}/instruments"

    @property
    def catalog(self) -> DataFrame:
        return facts.read_catalog(self.spark, self.catalog_path)

    def facts(self, spec: Feed) -> DataFrame:
        return facts.read_feed(self.spark, spec, self.table(spec)).drop("instr_bucket")

    def feeds(self, first: dt.date | None = None, last: dt.date | None = None) -> dict[str, DataFrame]:
        """Both fact tables, or just their days from ``first`` to ``last``."""
        if first is None or last is None:
            return {spec.name: facts.read_feed(self.spark, spec, self.table(spec)) for spec in (TRADES, LEVELS)}
        return {
            spec.name: facts.read_feed_days(self.spark, spec, self.table(spec), lambda day: first <= day <= last)
            for spec in (TRADES, LEVELS)
        }

    def request(
        self,
        base_asset: str,
        quote_asset: str,
        exchange: str,
        instrument_type: str = "perpetual",
        day: dt.date | str | None = None,
        feed: str | None = None,
    ) -> DataFrame:
        """A one-row request; larger ones are any DataFrame with the same columns."""
        row = (base_asset, quote_asset, exchange, instrument_type, day and as_day(day), feed)
        schema = ", ".join(f"{c} string" for c in IDENTITY) + ", trading_day date, feed string"
        return self.spark.createDataFrame([row], schema)

    # ---- instruments ----------------------------------------------------------------------------------------------
    def instrument(self, requests: DataFrame, at: dt.datetime | dt.date | str | None = None) -> DataFrame:
        return catalog_ops.current_instrument(self.catalog, requests, at)

    def instrument_by_id(self, ids: DataFrame) -> DataFrame:
        return catalog_ops.instrument_by_id(self.catalog, ids)

    def list_instruments(
        self, exchange: str, instrument_type: str, now: dt.datetime | dt.date | str | None = None
    ) -> DataFrame:
        return catalog_ops.list_instruments(self.catalog, exchange, instrument_type, now)

    def refresh_instruments(self, path: str, exchange: str) -> dict[str, int]:
        """Take an exchange's instrument list (JSON) into the catalog."""
        raw = raw_files.read_instruments(self.spark, path, exchange)
        return refresh.refresh_instruments(self.spark, raw, exchange, self.catalog_path)

    # ---- source files ---------------------------------------------------------------------------------------------
    def source_files(self, spec: Feed, wanted: DataFrame) -> DataFrame:
        """The delivered files of the wanted data sets and days: path, length, slug, dataset, file_day.

        The day folders of the wanted exchanges are listed, month by month, and the listing is joined with the wanted names,
        letter case aside. The driver sees one folder per exchange and day.
        """
        slug, day = exchange_slug(F.col("exchange")), F.col("trading_day")
        folders = wanted.select(slug.alias("slug"), day.alias("day")).where("slug IS NOT NULL").distinct().collect()
        months: dict[tuple, set[str]] = {}
        for row in folders:
            months.setdefault((row.slug, f"{row.day:%Y/%m}"), set()).add(f"{row.day:%d}")
        base = self.source.rstrip("/")
        patterns = [f"{base}/v1/{name}/{spec.segment}/{month}/{{{','.join(sorted(days))}}}" for (name, month), days in sorted(months.items())]
        names = wanted.select(slug.alias("slug"), F.upper("dataset").alias("dataset"), day.alias("file_day")).distinct()
        files = raw_files.list_delivered(self.spark, patterns)
        return stage(files.join(names, ["slug", "dataset", "file_day"], "left_semi"), "source-files")

    def source_rows(self, spec: Feed, files: DataFrame) -> DataFrame:
        """Raw rows of some delivered files; slug, data set and day are taken from each file's location."""
        paths = sorted(row.path for row in files.select("path").collect())
        raw = raw_files.read_raw(self.spark, spec, paths, check=False)
        return raw.withColumns(delivered_parts(F.col("_file")))

    def _page(self, spec: Feed, exchange: str, dataset: str, day: dt.date | str, count: int, skip: int) -> DataFrame:
        slug = exchange_slug(F.lit(exchange))
        name = source_location(slug, F.lit(spec.segment), F.lit(as_day(day)), F.lit(dataset))
        path = f"{self.source.rstrip('/')}/{self.spark.range(1).select(name).first()[0]}"
        return raw_files.page_file(self.spark, spec, path, count, skip)

    def page_trades(self, exchange: str, dataset: str, day: dt.date | str, count: int, skip: int = 0) -> DataFrame:
        """Trades straight from a source file, in file order."""
        return self._page(TRADES, exchange, dataset, day, count, skip)

    def page_level_updates(
        self, exchange: str, dataset: str, day: dt.date | str, count: int, skip: int = 0
    ) -> DataFrame:
        return self._page(LEVELS, exchange, dataset, day, count, skip)

    # ---- loads ----------------------------------------------------------------------------------------------------
    def buckets_of(self, spec: Feed) -> int:
        return stored_buckets(self.spark, self.table(spec)) or self.buckets

    def _stored(self) -> dict[str, int | None]:
        return {spec.name: stored_buckets(self.spark, self.table(spec)) for spec in (TRADES, LEVELS)}

    def _load(self, spec: Feed, requests: DataFrame, on_absent: str, options: dict) -> load.LoadReport:
        catalog = self.catalog
        wanted = load.requested_instruments(requests, catalog)
        files = self.source_files(spec, wanted)
        absent = stage(load.source_gaps(wanted, files, catalog), "absent")
        expected = absent.filter("expected").count()
        if expected and on_absent == "fail":
            raise load.FilesMissing(f"{expected} source files of trading days are not there")
        run = load.load_trades if spec is TRADES else load.load_level_updates
        options = {"unique": True, **options} if spec is LEVELS else options
        report = run(requests, catalog, self.source_rows(spec, files), self.table(spec), buckets=self.buckets_of(spec), **options)
        report.unknown = load.unknown_requests(requests, catalog).count()
        report.absent, report.absent_expected = absent, expected
        return report

    def load_trades(self, requests: DataFrame, on_absent: str = "report", **options) -> load.LoadReport:
        """Load instrument-days of trades; requests name an identity or an ``instrument_id``, and a ``trading_day``.

        Files of trading days that aren't there are reported, or with ``on_absent="fail"`` stop the load.
        """
        return self._load(TRADES, requests, on_absent, options)

    def load_level_updates(self, requests: DataFrame, on_absent: str = "report", **options) -> load.LoadReport:
        return self._load(LEVELS, requests, on_absent, options)

    def landed(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/landed/{FEEDS[feed].tag}"

    def land(self, requests: DataFrame, feed: str) -> landing.Landing:
        """Keep the delivered rows of instrument-days as they are; what other data sets have landed stays.

        Source files that were neither touched nor resized since they were landed aren't read.
        """
        spec, path, catalog = FEEDS[feed], self.landed(feed), self.catalog
        wanted = load.requested_instruments(requests, catalog)
        files = self.source_files(spec, wanted)
        days = wanted.select(
            exchange_slug(F.col("exchange")).alias("slug"), F.upper("dataset").alias("dataset"), F.col("trading_day").alias("file_day"),
            F.col("exchange").alias("venue"),
        )
        named = files.join(days.distinct(), ["slug", "dataset", "file_day"]).withColumn("feed", F.lit(spec.tag))
        named = named.withColumnRenamed("file_day", "trading_day")
        versions = stage(landing.source_versions(named), "source-versions")
        changed = stage(landing.changed_sources(versions, path), "changed-sources")
        fresh = named.join(changed.select(*landing.LANDED), landing.LANDED, "left_semi").select("path").distinct()
        raw = self.source_rows(spec, fresh)
        done = landing.land_requested(requests, catalog, raw, spec, path, changed)
        return replace(done, skipped=versions.count() - changed.count())

    def fold_landed(self, feed: str) -> int:
        """Remove landed rows that later landings replaced."""
        return landing.fold_landed(self.spark, FEEDS[feed], self.landed(feed))

    def import_cache(self, cache: str, exchange: str, instrument_type: str, **options) -> dict[str, load.LoadReport]:
        tables = {spec.name: self.table(spec) for spec in (TRADES, LEVELS)}
        return importing.import_cache(
            self.spark, cache, self.catalog, exchange, instrument_type, tables, buckets=self.buckets, **options
        )

    def manifest(
        self,
        listing: str,
        exchange: str,
        instrument_type: str,
        cache: str,
        feeds: Iterable[str] = ("trades", "l2"),
        **dates,
    ) -> DataFrame:
        """Files of an exchange and type that should be fetched and are not in the cache yet; without dates, yesterday's."""
        dates = dates or {"date": dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)}
        raw = raw_files.read_instruments(self.spark, listing, exchange)
        listed = manifest.listed_instruments(raw).filter(F.col("instrument_type") == instrument_type.strip().lower())
        wanted = manifest.download_manifest(listed, exchange_slug(F.col("exchange"), "download"), feeds, **dates)
        files = raw_files.list_cache(self.spark, cache)
        below = F.regexp_replace("path", r"^.*/([^/]+/[^/]+/[^/]+/[^/]+)$", "$1")
        return manifest.remaining(wanted, files.select(below.alias("cache"), "length"))

    # ---- coverage -------------------------------------------------------------------------------------------------
    def _day_rows(self, scope: coverage.Scope, requests: DataFrame, first: dt.date | None, last: dt.date | None) -> dict[str, DataFrame]:
        """A row per instrument and day of the feeds and days asked for, from the kept summaries. Without a range only the days
        of the requests count, and of days without a summary only the folders of their instruments."""
        rows = {}
        for spec in (TRADES, LEVELS):
            if spec.name in scope.feeds:
                path, pairs = self.table(spec), None
                if first is None and set(scope.days) & summaries.table_days(self.spark, path) - summaries.kept_days(self.spark, path):
                    pairs = coverage.requested_pairs(requests, self.catalog, self.buckets_of(spec))
                wanted = scope.days.__contains__ if first is None else lambda day: first <= day <= last
                rows[spec.name] = summaries.day_rows(self.spark, spec, path, wanted, pairs)
        return rows

    def info(self, requests: DataFrame) -> DataFrame:
        scope = coverage.scope_of(requests)
        rows = self._day_rows(scope, requests, None, None)
        return coverage.info_of_days(requests, self.catalog, rows or self._nothing())

    def _nothing(self) -> dict[str, DataFrame]:
        return {TRADES.name: summaries.day_rows(self.spark, TRADES, self.table(TRADES), lambda _: False)}

    def info_one(
        self,
        base_asset: str,
        quote_asset: str,
        exchange: str,
        instrument_type: str,
        day: dt.date | str,
        feed: str,
    ) -> DataFrame:
        """Count, first and last time of one feed-day, or no row."""
        identity = catalog_ops.has_identity(base_asset, quote_asset, exchange, instrument_type)
        feeds = self.feeds(as_day(day), as_day(day))
        return coverage.feed_day_info_one(self.catalog, feeds, identity, feed, day, self._stored().get(feed))

    def missing_days(
        self, requests: DataFrame, start: dt.date | str | None = None, as_of: dt.date | str | None = None
    ) -> DataFrame:
        last = as_day(as_of or dt.datetime.now(dt.timezone.utc).date())
        scope = coverage.scope_of(requests)
        first = (scope.first or last) if start is None else as_day(start)
        rows = self._day_rows(scope, requests, first, last) if first <= last else {}
        return coverage.in_day_order(coverage.missing_in_days(requests, self.catalog, rows, start, last))

    def exists(self, requests: DataFrame) -> DataFrame:
        scope = coverage.scope_of(requests)
        rows = self._day_rows(scope, requests, None, None)
        return coverage.exists_in_days(requests, self.catalog, rows or self._nothing())

    def mend_summaries(self) -> dict[str, list[dt.date]]:
        """Summarise the days that were written by other means than loads."""
        return {spec.name: summaries.mend(self.spark, spec, self.table(spec)) for spec in (TRADES, LEVELS)}

    def storage_report(self) -> DataFrame:
        return maintenance.storage_report(self.spark, {spec.name: self.table(spec) for spec in (TRADES, LEVELS)})

    # ---- maintenance ----------------------------------------------------------------------------------------------
    def compact(self, feed: str, as_of: dt.date | str, **options) -> int:
        spec = FEEDS[feed]
        return maintenance.compact_cold(self.spark, self.table(spec), as_of, buckets=self.buckets_of(spec), **options)

    def drop_expired(self, feed: str, as_of: dt.date | str, days: int = maintenance.RETAIN_DAYS) -> int:
        return maintenance.drop_expired_days(self.spark, self.table(FEEDS[feed]), as_of, days)

    def rollup_path(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/hourly_{FEEDS[feed].tag}"

    def refresh_rollup(self, feed: str, now: dt.datetime | None = None) -> int:
        """Compute the hours of the refresh window anew in the kept hourly rollup of prices."""
        now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return maintenance.keep_rollup(self.spark, FEEDS[feed], self.table(FEEDS[feed]), self.rollup_path(feed), now)

    def rollup(self, feed: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Hourly average prices per instrument, as the refreshes left them."""
        return maintenance.read_kept_rollup(self.spark, self.rollup_path(feed), first, last).drop("day")
