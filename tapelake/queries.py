"""The registered queries: every operator of the lake over whole tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.fixtures import Fixtures
from tapelake.lake import Lake
from tapelake.functions import locations, sides, times, venues
from tapelake.operators import catalog, coverage, dedup, layout, manifest, normalize, sequence, validate
from tapelake.operators import pages as pages_ops
from tapelake.operators.layout import spread
from tapelake.oracles import sql
from tapelake.plans import importing, landing, load, maintenance, refresh, summaries
from tapelake.plans.staging import child_names, new_folder, stage
from tapelake.schemas import IDENTITY, INSTRUMENT_FIELDS, LEVELS, PRICE, TRADES
from tapelake.session import configure
from tapelake.sources import facts, raw_files
from tapelake.streaming import ingest, ledger, rollup, unique

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The days the trade fixtures cover, and a month of the level updates.
FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
LEVEL_FIRST, LEVEL_LAST = dt.date(2000, 1, 1), dt.date(2000, 1, 31)


# Catalog flags that may be unknown.
OPEN_FLAGS = ("margin", "inverse")


def present(df: DataFrame) -> DataFrame:
    """One spelling of values for comparisons: days and open flags as text, decimals as double, integers as bigint, times
    without zone."""
    columns = []
    for field in df.schema:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif field.name in OPEN_FLAGS:
            column = column.cast("string")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(oracle: str | None = None) -> Callable[[Callable[[Fixtures], DataFrame]], Callable]:
    """Register a function of the fixtures as a query."""

    def register(build: Callable[[Fixtures], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return present(build(Fixtures(configure(spark), folder)))

        QUERIES[build.__name__] = run
        if oracle:
            ORACLES[build.__name__] = sql(oracle)
        return build

    return register


def as_stored(df: DataFrame) -> DataFrame:
    """Fixture facts with the types of the stored tables."""
    return df.withColumns(
        {"ts": F.col("ts").cast("timestamp"), "instrument_id": F.col("instrument_id").cast("string")}
    )


# ---- coverage ---------------------------------------------------------------------------------------------------------
@query("""SELECT instrument_id, trading_day, count(*) AS items_count, min(ts) AS first_ts, max(ts) AS last_ts
FROM fx_trades GROUP BY 1, 2""")
def feed_day_info_trades(fx: Fixtures) -> DataFrame:
    return coverage.feed_days(fx.trades(), TRADES.name).drop("feed")


@query("""SELECT instrument_id, trading_day, count(*) AS items_count, min(ts) AS first_ts, max(ts) AS last_ts
FROM fx_levels GROUP BY 1, 2""")
def feed_day_info_levels(fx: Fixtures) -> DataFrame:
    return coverage.feed_days(fx.levels(), LEVELS.name).drop("feed")


def _requests(fx: Fixtures, *feeds: str) -> DataFrame:
    """Every instrument with every given feed."""
    names = spread(fx.instruments().select(*IDENTITY), *IDENTITY)
    return names.select(*IDENTITY, F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed"))


def _daily(requests: DataFrame) -> DataFrame:
    """A request for each day of the trades' month."""
    return requests.withColumn("trading_day", coverage.calendar(F.lit(FIRST), F.lit(LAST)))


def _facts(fx: Fixtures) -> dict[str, DataFrame]:
    return {TRADES.name: fx.trades(), LEVELS.name: fx.levels()}


@query("""SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, 'Trades' AS feed, i.instrument_id,
  t.trading_day, count(*) AS items_count, min(t.ts) AS first_ts, max(t.ts) AS last_ts
FROM fx_instruments i JOIN fx_trades t ON t.instrument_id = i.instrument_id
WHERE t.ts >= TIMESTAMP '2024-01-01' AND t.ts < TIMESTAMP '2024-02-01' GROUP BY ALL""")
def feed_day_info_requests(fx: Fixtures) -> DataFrame:
    requests = _daily(_requests(fx, "Trades", "LevelUpdates", "OrdersLog"))
    return coverage.feed_day_info(requests, fx.instruments(), _facts(fx))


LEVEL_DAYS = f"ts >= TIMESTAMP '{LEVEL_FIRST}' AND ts < TIMESTAMP '{LEVEL_LAST}' + INTERVAL 1 DAY"


@query(f"""SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, 'LevelUpdates' AS feed, i.instrument_id,
  t.trading_day, count(*) AS items_count, min(t.ts) AS first_ts, max(t.ts) AS last_ts
FROM fx_instruments i JOIN fx_levels t ON t.instrument_id = i.instrument_id WHERE {LEVEL_DAYS} GROUP BY ALL""")
def feed_day_info_level_requests(fx: Fixtures) -> DataFrame:
    days = coverage.calendar(F.lit(LEVEL_FIRST), F.lit(LEVEL_LAST))
    requests = _requests(fx, "Trades", "LevelUpdates").withColumn("trading_day", days)
    return coverage.feed_day_info(requests, fx.instruments(), _facts(fx))


@query(f"""SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, 'LevelUpdates' AS feed, CAST(CAST(d.d AS DATE) AS VARCHAR) AS trading_day,
  EXISTS (SELECT 1 FROM (SELECT DISTINCT instrument_id, trading_day FROM fx_levels) p WHERE p.instrument_id = i.instrument_id
    AND p.trading_day = CAST(CAST(d.d AS DATE) AS VARCHAR)) AS has_data
FROM fx_instruments i CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{LEVEL_FIRST}', TIMESTAMP '{LEVEL_LAST}', INTERVAL 1 DAY)) AS d) d""")
def exists_levels_on_day(fx: Fixtures) -> DataFrame:
    requests = _requests(fx, "LevelUpdates").withColumn("trading_day", coverage.calendar(F.lit(LEVEL_FIRST), F.lit(LEVEL_LAST)))
    return coverage.exists_feed_on_day(requests, fx.instruments(), _facts(fx))


@query("""SELECT count(*) AS items_count, min(t.ts) AS first_ts, max(t.ts) AS last_ts FROM fx_instruments i
JOIN fx_trades t ON t.instrument_id = i.instrument_id WHERE i.base_asset = 'A7' AND t.trading_day = '2024-01-10' HAVING count(*) > 0""")
def feed_day_info_one(fx: Fixtures) -> DataFrame:
    return coverage.feed_day_info_one(fx.instruments(), _facts(fx), F.col("base_asset") == "A7", "Trades", "2024-01-10")


MISSING = """SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, '{feed}' AS feed,
  CAST(CAST(d.d AS DATE) AS VARCHAR) AS trading_day
FROM fx_instruments i CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 DAY)) AS d) d
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT instrument_id, trading_day FROM {view}) p
  WHERE p.instrument_id = i.instrument_id AND p.trading_day = CAST(CAST(d.d AS DATE) AS VARCHAR))"""


@query(MISSING.format(feed="Trades", first=FIRST, last=LAST, view="fx_trades"))
def missing_days(fx: Fixtures) -> DataFrame:
    return coverage.in_day_order(
        coverage.missing_days(_requests(fx, "Trades"), fx.instruments(), _facts(fx), FIRST, LAST)
    )


@query(MISSING.format(feed="LevelUpdates", first=LEVEL_FIRST, last=LEVEL_LAST, view="fx_levels"))
def missing_days_levels(fx: Fixtures) -> DataFrame:
    requests = _requests(fx, "LevelUpdates")
    return coverage.missing_days(requests, fx.instruments(), _facts(fx), LEVEL_FIRST, LEVEL_LAST)


@query("""SELECT 'S' || CAST(s.s_suppkey AS VARCHAR) AS base_asset, 'USD' AS quote_asset, 'BinanceSpot' AS exchange,
  'spot' AS instrument_type, 'Trades' AS feed, CAST(CAST(d.d AS DATE) AS VARCHAR) AS trading_day
FROM supplier s CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d) d""")
def missing_days_unresolved(fx: Fixtures) -> DataFrame:
    requests = fx.table("supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("base_asset"),
        F.lit("USD").alias("quote_asset"),
        F.lit("BinanceSpot").alias("exchange"),
        F.lit("spot").alias("instrument_type"),
        F.lit("Trades").alias("feed"),
    )
    return coverage.missing_days(requests, fx.instruments(), _facts(fx), FIRST, LAST)


@query("""SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, 'OrdersLog' AS feed,
  CAST(CAST(d.d AS DATE) AS VARCHAR) AS trading_day
FROM fx_instruments i CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS d) d""")
def missing_days_unsupported_feed(fx: Fixtures) -> DataFrame:
    requests = _requests(fx, "OrdersLog")
    return coverage.missing_days(requests, fx.instruments(), _facts(fx), dt.date(2024, 1, 10), dt.date(2024, 1, 20))


@query("""WITH present AS (SELECT DISTINCT 'Trades' AS feed, instrument_id, trading_day FROM fx_trades
  UNION ALL SELECT DISTINCT 'LevelUpdates', instrument_id, trading_day FROM fx_levels)
SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, f.feed, CAST(CAST(d.d AS DATE) AS VARCHAR) AS trading_day,
  p.feed IS NOT NULL AS has_data
FROM fx_instruments i CROSS JOIN (VALUES ('Trades'), ('LevelUpdates'), ('OrdersLog')) f(feed)
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d) d
LEFT JOIN present p ON p.feed = f.feed AND p.instrument_id = i.instrument_id AND p.trading_day = CAST(CAST(d.d AS DATE) AS VARCHAR)""")
def exists_feed_on_day(fx: Fixtures) -> DataFrame:
    requests = _daily(_requests(fx, "Trades", "LevelUpdates", "OrdersLog"))
    return coverage.exists_feed_on_day(requests, fx.instruments(), _facts(fx))


@query("""WITH starts AS (SELECT base_asset, quote_asset, exchange, instrument_type, instrument_id, CAST(coalesce(listing, TIMESTAMP '2024-01-25') AS DATE) AS first FROM fx_instruments),
days AS (SELECT s.*, CAST(CAST(unnest(generate_series(CAST(first AS TIMESTAMP), TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS trading_day FROM starts s)
SELECT base_asset, quote_asset, exchange, instrument_type, 'Trades' AS feed, trading_day FROM days d WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT instrument_id, trading_day FROM fx_trades) p WHERE p.instrument_id = d.instrument_id AND p.trading_day = d.trading_day)""")
def missing_days_since_listing(fx: Fixtures) -> DataFrame:
    """Every instrument from its own first day on."""
    first = F.to_date(F.coalesce("listing", F.lit("2024-01-25").cast("timestamp_ntz")))
    requests = fx.instruments().select(*IDENTITY, F.lit("Trades").alias("feed"), first.alias("trading_day"))
    return coverage.missing_days(requests, fx.instruments(), _facts(fx), as_of=LAST)


@query("""SELECT DISTINCT 'Trades' AS feed, instrument_id, trading_day FROM fx_trades
UNION ALL SELECT DISTINCT 'LevelUpdates', instrument_id, trading_day FROM fx_levels""")
def present_days(fx: Fixtures) -> DataFrame:
    return coverage.both_feeds({feed: coverage.present_days(df, feed) for feed, df in _facts(fx).items()})


@query("""SELECT feed, trading_day, count(*) AS items_count FROM (
  SELECT 'Trades' AS feed, trading_day FROM fx_trades UNION ALL SELECT 'LevelUpdates', trading_day FROM fx_levels)
GROUP BY 1, 2""")
def feed_union_counts(fx: Fixtures) -> DataFrame:
    return coverage.feed_counts(_facts(fx))


@query("""SELECT o_custkey AS instrument_id, CAST(CAST(d AS DATE) AS VARCHAR) AS trading_day FROM (
  SELECT o_custkey, unnest(generate_series(CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP),
    CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) + INTERVAL 9 DAY, INTERVAL 1 DAY)) AS d FROM orders GROUP BY 1)""")
def calendar(fx: Fixtures) -> DataFrame:
    starts = fx.table("orders").groupBy(F.col("o_custkey").alias("instrument_id")).agg(
        F.to_date(F.min("o_orderdate")).alias("start")
    )
    days = coverage.calendar(F.col("start"), F.date_add("start", 9))
    return starts.select("instrument_id", days.alias("trading_day"))


@query("""SELECT ts, instrument_id, side, price, quantity, trade_id, trading_day FROM fx_trades
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15'""")
def scan_feed(fx: Fixtures) -> DataFrame:
    path = new_folder(fx.spark, "scan-feed")
    layout.write_layout(as_stored(fx.trades()), path, buckets=2)
    rows = facts.scan_feed(fx.spark, TRADES, path, "2024-01-10", "2024-01-14", buckets=2)
    return rows.withColumn("instrument_id", F.col("instrument_id").cast("bigint"))


def _lake(fx: Fixtures) -> Lake:
    """A lake with the trades in two loads, the second of which adds to days of the first, and the catalog."""
    lake = Lake(fx.spark, new_folder(fx.spark, "lake"), "none", buckets=2)
    fx.instruments().withColumn("instrument_id", F.col("instrument_id").cast("string")).write.partitionBy("exchange").parquet(lake.catalog_path)
    rows = as_stored(fx.trades())
    for part in (rows.filter("side <> 0"), rows):
        load.append_trades(part, lake.table(TRADES), on_invalid="reject", buckets=2)
    return lake


VALID = "price > 0 AND quantity >= 0"


@query(f"""SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, 'Trades' AS feed, CAST(i.instrument_id AS VARCHAR) AS instrument_id,
  t.trading_day, count(*) AS items_count, min(t.ts) AS first_ts, max(t.ts) AS last_ts
FROM fx_instruments i JOIN fx_trades t ON t.instrument_id = i.instrument_id
WHERE t.ts >= TIMESTAMP '2024-01-01' AND t.ts < TIMESTAMP '2024-02-01' AND {VALID} GROUP BY ALL""")
def kept_day_info(fx: Fixtures) -> DataFrame:
    """Infos of every instrument-day of the month, from the summaries that the loads kept."""
    return _lake(fx).info(_daily(_requests(fx, "Trades", "LevelUpdates", "OrdersLog")))


@query(MISSING.format(feed="Trades", first=FIRST, last=LAST, view=f"(SELECT * FROM fx_trades WHERE {VALID})"))
def kept_missing_days(fx: Fixtures) -> DataFrame:
    return _lake(fx).missing_days(_requests(fx, "Trades"), FIRST, LAST)


@query(f"""SELECT i.base_asset, i.quote_asset, i.exchange, i.instrument_type, f.feed, CAST(CAST(d.d AS DATE) AS VARCHAR) AS trading_day, p.instrument_id IS NOT NULL AS has_data
FROM fx_instruments i CROSS JOIN (VALUES ('Trades'), ('OrdersLog')) f(feed)
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d) d
LEFT JOIN (SELECT DISTINCT instrument_id, trading_day FROM fx_trades WHERE {VALID}) p
  ON f.feed = 'Trades' AND p.instrument_id = i.instrument_id AND p.trading_day = CAST(CAST(d.d AS DATE) AS VARCHAR)""")
def kept_exists_on_day(fx: Fixtures) -> DataFrame:
    """Which feed-days exist, when every third day lost its summary and is counted from the facts of its instruments."""
    lake = _lake(fx)
    path = lake.table(TRADES)
    summaries.mark(fx.spark, path, sorted(summaries.table_days(fx.spark, path))[::3])
    return lake.exists(_daily(_requests(fx, "Trades", "OrdersLog")))


# ---- catalog queries --------------------------------------------------------------------------------------------------
VIEW_COLUMNS = ", ".join(["instrument_id", "symbol_id", *IDENTITY, *INSTRUMENT_FIELDS])


def _star(fx: Fixtures) -> DataFrame:
    flat = fx.instruments()
    keyed = flat.select("instrument_id", "symbol_id", "instrument_type", *INSTRUMENT_FIELDS)
    return catalog.instrument_view(
        keyed, catalog.symbols_of(flat), catalog.exchange_names(flat), catalog.asset_names(flat)
    )


@query(f"SELECT {VIEW_COLUMNS} FROM fx_instruments")
def instrument_view(fx: Fixtures) -> DataFrame:
    return _star(fx)


def _identities(fx: Fixtures) -> DataFrame:
    """Every instrument's identity, and as many that do not exist."""
    known = fx.instruments().select(*IDENTITY)
    return known.unionByName(known.withColumn("base_asset", F.lower("base_asset")))


@query(f"SELECT {VIEW_COLUMNS} FROM fx_instruments")
def instrument_current(fx: Fixtures) -> DataFrame:
    return catalog.current_instrument(fx.instruments(), _identities(fx))


@query(f"""SELECT {VIEW_COLUMNS} FROM fx_instruments WHERE coalesce(listing <= TIMESTAMP '2024-01-20', true)
AND (expiration IS NULL OR TIMESTAMP '2024-01-20' < expiration)""")
def instrument_at(fx: Fixtures) -> DataFrame:
    return catalog.current_instrument(fx.instruments(), _identities(fx), "2024-01-20")


@query(f"""SELECT {VIEW_COLUMNS} FROM (SELECT * FROM fx_instruments
  UNION ALL SELECT * REPLACE (instrument_id + 1000000 AS instrument_id, listing + INTERVAL 1 DAY AS listing) FROM fx_instruments WHERE instrument_id % 2 = 0
  UNION ALL SELECT * REPLACE (instrument_id + 2000000 AS instrument_id) FROM fx_instruments WHERE instrument_id % 3 = 0
  UNION ALL SELECT * REPLACE (instrument_id - 3000000 AS instrument_id, NULL AS listing) FROM fx_instruments WHERE instrument_id % 5 = 0)
QUALIFY row_number() OVER (PARTITION BY base_asset, quote_asset, exchange, instrument_type ORDER BY listing DESC NULLS LAST, instrument_id) = 1""")
def instrument_current_of_several(fx: Fixtures) -> DataFrame:
    """Identities that several instruments have: the latest listing wins, the smallest id among equal ones, an unknown listing last."""
    one = fx.instruments()
    key = F.col("instrument_id")
    later = one.filter(key % 2 == 0).withColumns({"instrument_id": key + 1_000_000, "listing": F.col("listing") + F.expr("INTERVAL 1 DAY")})
    equal = one.filter(key % 3 == 0).withColumn("instrument_id", key + 2_000_000)
    unlisted = one.filter(key % 5 == 0).withColumns({"instrument_id": key - 3_000_000, "listing": F.lit(None).cast(one.schema["listing"].dataType)})
    several = one.unionByName(later).unionByName(equal).unionByName(unlisted)
    return catalog.current_instrument(several, _identities(fx))


@query(f"SELECT {VIEW_COLUMNS} FROM fx_instruments WHERE instrument_id IN (SELECT s_suppkey FROM supplier)")
def instrument_by_id(fx: Fixtures) -> DataFrame:
    ids = fx.table("supplier").select(F.col("s_suppkey").alias("instrument_id"))
    return catalog.instrument_by_id(fx.instruments(), ids)


@query(f"""SELECT {VIEW_COLUMNS} FROM fx_instruments WHERE exchange = 'BinanceFutures' AND instrument_type = 'perpetual'
AND active AND (expiration IS NULL OR TIMESTAMP '2024-02-01' < expiration)""")
def instruments_listed(fx: Fixtures) -> DataFrame:
    return catalog.list_instruments(fx.instruments(), "BinanceFutures", "perpetual", "2024-02-01")


@query("""SELECT instrument_id,
  (listing IS NULL OR DATE '2024-01-20' >= CAST(listing AS DATE)) AND (expiration IS NULL OR DATE '2024-01-20' < CAST(expiration AS DATE)) AS available,
  coalesce(DATE '2024-01-20' > CAST(listing AS DATE) AND DATE '2024-01-20' < CAST(expiration AS DATE), false) AS trading,
  coalesce(listing <= TIMESTAMP '2024-01-20', true) AND (expiration IS NULL OR TIMESTAMP '2024-01-20' < expiration) AS valid,
  active AND (expiration IS NULL OR TIMESTAMP '2024-01-20' < expiration) AS listed
FROM fx_instruments""")
def availability_rules(fx: Fixtures) -> DataFrame:
    rows = fx.instruments()
    day = F.lit(dt.date(2024, 1, 20))
    at = times.instant_like(rows, "listing", dt.date(2024, 1, 20))
    since, to = F.to_date("listing"), F.to_date("expiration")
    return rows.select(
        "instrument_id",
        catalog.available_on(day, since, to).alias("available"),
        catalog.is_trading_date(day, since, to).alias("trading"),
        catalog.valid_at(at).alias("valid"),
        catalog.currently_listed(at).alias("listed"),
    )


@query("""SELECT dataset, instrument_id FROM fx_instruments WHERE exchange = 'KucoinSpot' AND instrument_type = 'spot'""")
def dataset_map(fx: Fixtures) -> DataFrame:
    return facts.dataset_map(fx.instruments(), "KucoinSpot", "spot")


CODES = """CASE exchange WHEN 'BinanceSpot' THEN 17 WHEN 'BinanceFutures' THEN 18 WHEN 'OkexFutures' THEN 34
  WHEN 'KucoinSpot' THEN 129 ELSE 130 END"""


@query(f"""SELECT instrument_id, CAST({CODES} AS BIGINT) AS code, {CODES} & 176 <> 0 AS is_crypto,
  {CODES} & 64 <> 0 AS is_classic, {CODES} & 1 <> 0 AS is_spot FROM fx_instruments""")
def exchange_groups(fx: Fixtures) -> DataFrame:
    code = venues.exchange_code(F.col("exchange"))
    return fx.instruments().select(
        "instrument_id",
        code.alias("code"),
        venues.in_group(code, "Crypto").alias("is_crypto"),
        venues.in_group(code, "Classic").alias("is_classic"),
        venues.in_group(code, "Spot").alias("is_spot"),
    )


SLUG = """CASE exchange WHEN 'BinanceSpot' THEN 'binance' WHEN 'BinanceFutures' THEN 'binance-futures'
  WHEN 'OkexFutures' THEN 'okex-futures' WHEN 'KucoinSpot' THEN 'kucoin' ELSE 'kucoin-futures' END"""


@query(f"""SELECT instrument_id, {SLUG} AS canonical, {SLUG} AS download,
  CASE exchange WHEN 'BinanceSpot' THEN 'binance-spot' WHEN 'OkexFutures' THEN 'okx-futures' WHEN 'KucoinSpot' THEN 'kucoin-spot' ELSE {SLUG} END AS import,
  CASE exchange WHEN 'BinanceSpot' THEN 'binance-spot' WHEN 'KucoinSpot' THEN 'kucoin-spot' ELSE {SLUG} END AS refresh,
  exchange AS back FROM fx_instruments""")
def slug_lookup(fx: Fixtures) -> DataFrame:
    name = F.col("exchange")
    styles = ["canonical", "download", "import", "refresh"]
    return fx.instruments().select(
        "instrument_id",
        *[venues.exchange_slug(name, style).alias(style) for style in styles],
        venues.slug_exchange(venues.exchange_slug(name)).alias("back"),
    )


# ---- normalization ----------------------------------------------------------------------------------------------------
@query("""SELECT ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS trading_day, strftime(ts, '%H:%M:%S.%f') AS time_of_day, instrument_id,
  CAST(CASE side WHEN 'buy' THEN 1 WHEN 'sell' THEN -1 ELSE 0 END AS BIGINT) AS side, price, amount AS quantity, id AS trade_id
FROM raw_trades WHERE timestamp IS NOT NULL""")
def normalize_trades(fx: Fixtures) -> DataFrame:
    return normalize.normalize_trades(fx.raw_trades()).withColumn("time_of_day", times.time_of_day(F.col("ts")))


@query("""SELECT ts, file_day AS trading_day, instrument_id,
  CAST(CASE side WHEN 'bid' THEN 1 WHEN 'ask' THEN -1 ELSE 0 END AS BIGINT) AS side, price, amount AS quantity, is_snapshot,
  row_number() OVER (PARTITION BY instrument_id, file_day ORDER BY timestamp, local_timestamp, price, amount, side, is_snapshot) AS update_seq
FROM raw_levels""")
def normalize_levels(fx: Fixtures) -> DataFrame:
    numbered = normalize.sequence_sorted(fx.raw_levels(), ["instrument_id", "file_day"])
    return normalize.normalize_levels(numbered)


@query("""SELECT id, 'trades' AS tag, CAST(CASE lower(side) WHEN 'buy' THEN 1 WHEN 'sell' THEN 2 END AS BIGINT) AS side_code FROM raw_trades
UNION ALL SELECT local_timestamp - timestamp, 'l2', CAST(CASE lower(side) WHEN 'bid' THEN 1 WHEN 'ask' THEN 2 END AS BIGINT) FROM raw_levels""")
def script_side_codes(fx: Fixtures) -> DataFrame:
    side = F.col("side")
    trades = fx.raw_trades().select("id", F.lit("trades").alias("tag"), sides.script_side(side, "trades").alias("side_code"))
    order = F.col("local_timestamp") - F.col("timestamp")
    levels = fx.raw_levels().select(order.alias("id"), F.lit("l2").alias("tag"), sides.script_side(side, "l2").alias("side_code"))
    return trades.unionByName(levels)


@query("""SELECT id, instrument_id, symbol, local_timestamp, price FROM raw_trades WHERE timestamp IS NULL""")
def rows_without_time(fx: Fixtures) -> DataFrame:
    rows = normalize.without_raw_time(fx.raw_trades())
    return rows.select("id", "instrument_id", "symbol", "local_timestamp", "price")


SORTED = "ORDER BY timestamp, local_timestamp, price, amount, side, is_snapshot"


@query(f"""SELECT instrument_id, file_day, timestamp, local_timestamp, price, amount, side, is_snapshot,
  row_number() OVER (PARTITION BY instrument_id, file_day {SORTED}) AS update_seq FROM raw_levels""")
def level_seq_sorted(fx: Fixtures) -> DataFrame:
    return normalize.sequence_sorted(fx.raw_levels(), ["instrument_id", "file_day"]).drop("exchange", "symbol")


@query("""SELECT side, symbol, timestamp, local_timestamp, price, amount, is_snapshot, row_number() OVER (
  PARTITION BY side ORDER BY timestamp, local_timestamp, price, amount, symbol, is_snapshot) AS update_seq FROM raw_levels""")
def level_seq_large_groups(fx: Fixtures) -> DataFrame:
    """Three large groups, numbered in slices."""
    rows = fx.raw_levels().select("side", "symbol", "timestamp", "local_timestamp", "price", "amount", "is_snapshot")
    order = ["timestamp", "local_timestamp", "price", "amount", "symbol", "is_snapshot"]
    return sequence.number_rows(rows, ["side"], order, group_rows=rows.count() // 20 + 1)


@query("""SELECT instrument_id, file_day, id, row_number() OVER (PARTITION BY instrument_id, file_day ORDER BY id) - 1 AS update_seq
FROM raw_trades WHERE timestamp IS NOT NULL""")
def level_seq_arrival(fx: Fixtures) -> DataFrame:
    rows = normalize.sequence_arrival(fx.raw_trades(), ["instrument_id", "file_day"], arrival="id")
    return rows.select("instrument_id", "file_day", "id", "update_seq")


@query("""WITH held AS (SELECT instrument_id, trading_day, max(update_seq) + 1 AS next FROM fx_levels WHERE is_snapshot GROUP BY 1, 2),
fresh AS (SELECT *, row_number() OVER (PARTITION BY instrument_id, trading_day ORDER BY price, quantity, side, update_seq) - 1 AS seq FROM fx_levels WHERE NOT is_snapshot)
SELECT f.instrument_id, f.trading_day, f.price, f.quantity, f.side, f.seq + coalesce(h.next, 0) AS update_seq
FROM fresh f LEFT JOIN held h ON h.instrument_id = f.instrument_id AND h.trading_day = f.trading_day""")
def level_seq_day_continuous(fx: Fixtures) -> DataFrame:
    day = ["instrument_id", "trading_day"]
    held = fx.levels().filter("is_snapshot")
    fresh = fx.levels().filter("not is_snapshot").withColumnRenamed("update_seq", "line")
    numbered = sequence.number_rows(fresh, day, ["price", "quantity", "side", "line"], start=0)
    return sequence.continue_sequence(numbered, held, day).select(*day, "price", "quantity", "side", "update_seq")


@query("""SELECT instrument_id, trade_id, trading_day, strftime(ts, '%H:%M:%S.%f') AS time_utc,
  CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS tokyo_day, strftime(ts + INTERVAL 9 HOUR, '%H:%M:%S.%f') AS tokyo_time,
  CAST(CAST(ts + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS next_day, epoch_us(ts) AS micros FROM fx_trades""")
def time_parts(fx: Fixtures) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return fx.trades().select(
        "instrument_id",
        "trade_id",
        times.trading_day(ts).alias("trading_day"),
        times.time_of_day(ts).alias("time_utc"),
        times.day_in_zone(ts, "Asia/Tokyo").alias("tokyo_day"),
        times.time_in_zone(ts, "Asia/Tokyo").alias("tokyo_time"),
        times.next_day(times.trading_day(ts)).alias("next_day"),
        F.unix_micros(ts).alias("micros"),
    )


@query("""SELECT ts, instrument_id, side, price, quantity, trade_id FROM (
  SELECT l_shipdate AS ts, CAST(l_suppkey AS VARCHAR) AS instrument_id, CAST(1 AS BIGINT) AS side,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity, l_orderkey AS trade_id FROM lineitem
  UNION ALL SELECT l_shipdate + INTERVAL 1 DAY, CAST(l_suppkey AS VARCHAR), -1, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE), 0, l_partkey FROM lineitem)""")
def unnest_batch(fx: Fixtures) -> DataFrame:
    text = F.col("l_suppkey").cast("string")
    price, quantity = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_quantity").cast("decimal(18,2)")
    batch = fx.table("lineitem").select(
        F.array(F.col("l_shipdate"), F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("ts"),
        F.array(text, text).alias("instrument_id"),
        F.array(F.lit("1"), F.lit("-1")).alias("side"),
        F.array(price.cast("string"), quantity.cast("string")).alias("price"),
        F.array(quantity.cast("string"), F.lit("0")).alias("quantity"),
        F.array("l_orderkey", "l_partkey").alias("trade_id"),
    )
    kinds = {
        "ts": "timestamp_ntz",
        "instrument_id": "string",
        "side": "smallint",
        "price": "decimal(38,18)",
        "quantity": "decimal(38,18)",
        "trade_id": "bigint",
    }
    return facts.rows_from_arrays(batch, kinds)


# ---- validation -------------------------------------------------------------------------------------------------------
@query("""SELECT *, CASE WHEN price <= 0 THEN 'price out of range' WHEN quantity < 0 THEN 'quantity out of range' END AS reason
FROM (SELECT ts, instrument_id, side, price - 20 AS price, quantity - 2 AS quantity, trade_id, trading_day FROM (
  SELECT * REPLACE (CAST(price AS DECIMAL(18,2)) AS price) FROM fx_trades)) WHERE price <= 0 OR quantity < 0""".replace(
    "SELECT *, CASE", "SELECT ts, instrument_id, side, CAST(price AS DOUBLE) AS price, quantity, trade_id, trading_day, CASE"
))
def validate_trades(fx: Fixtures) -> DataFrame:
    shifted = fx.trades().withColumns(
        {"price": (F.col("price") - 20).cast(PRICE), "quantity": (F.col("quantity") - 2).cast(PRICE)}
    )
    return validate.rejected(validate.check_domain(shifted, TRADES))


@query("""SELECT ts, instrument_id, side, CAST(price AS DOUBLE) AS price, quantity, is_snapshot, update_seq, trading_day,
  CASE WHEN price < 0 THEN 'price out of range' WHEN quantity < 0 THEN 'quantity out of range' END AS reason
FROM (SELECT ts, instrument_id, side, CAST(price AS DECIMAL(18,2)) - 2000 AS price, quantity - 10 AS quantity, is_snapshot, update_seq, trading_day FROM fx_levels)
WHERE price < 0 OR quantity < 0""")
def validate_levels(fx: Fixtures) -> DataFrame:
    shifted = fx.levels().withColumns(
        {"price": (F.col("price") - 2000).cast(PRICE), "quantity": (F.col("quantity") - 10).cast(PRICE)}
    )
    return validate.rejected(validate.check_domain(shifted, LEVELS))


@query("""SELECT id AS trade_id, instrument_id, 'null ts' AS reason FROM raw_trades WHERE timestamp IS NULL""")
def null_facts(fx: Fixtures) -> DataFrame:
    ts = times.micros_to_timestamp(F.col("timestamp"))
    rows = fx.raw_trades().select(
        ts.alias("ts"), "instrument_id", sides.trade_side(F.col("side")).alias("side"), "price",
        F.col("amount").alias("quantity"), F.col("id").alias("trade_id"), times.trading_day(ts).alias("trading_day"),
    )
    return validate.rejected(validate.check_not_null(rows, TRADES)).select("trade_id", "instrument_id", "reason")


@query("""SELECT * FROM fx_trades t WHERE NOT EXISTS (
  SELECT 1 FROM fx_instruments i WHERE i.instrument_id = t.instrument_id AND i.instrument_type <> 'spot')""")
def orphan_facts(fx: Fixtures) -> DataFrame:
    return validate.orphans(fx.trades(), fx.instruments().filter("instrument_type <> 'spot'"))


@query("""SELECT instrument_id, CASE WHEN price_increment <= 0 THEN 'price increment' WHEN amount_increment <= 0 THEN 'amount increment'
  WHEN maker_fee < 0 THEN 'maker fee' WHEN contract_multiplier <= 0 THEN 'contract multiplier' END AS reason
FROM fx_instruments WHERE price_increment <= 0 OR amount_increment <= 0 OR maker_fee < 0 OR contract_multiplier <= 0""")
def check_instruments(fx: Fixtures) -> DataFrame:
    return validate.rejected(validate.check_instruments(fx.instruments())).select("instrument_id", "reason")


# ---- de-duplication and idempotent inserts ----------------------------------------------------------------------------
@query("""SELECT * FROM fx_trades QUALIFY row_number() OVER (PARTITION BY instrument_id, ts, trade_id ORDER BY side, price, quantity) = 1""")
def dedup_trades_ts_key(fx: Fixtures) -> DataFrame:
    return dedup.first_per_key(fx.trades(), TRADES.key, TRADES.rest)


LEVEL_REST = "side, price, quantity, is_snapshot"


@query(f"""SELECT * FROM fx_levels QUALIFY row_number() OVER (PARTITION BY instrument_id, ts, update_seq ORDER BY {LEVEL_REST}) = 1""")
def dedup_levels_ts_key(fx: Fixtures) -> DataFrame:
    return dedup.first_per_key(fx.levels(), LEVELS.key, LEVELS.rest)


def _coarse(fx: Fixtures) -> DataFrame:
    """Trades whose ids repeat within a day."""
    return fx.trades().withColumn("trade_id", F.floor(F.col("quantity") / 20).cast("bigint"))


COARSE = "SELECT * REPLACE (CAST(floor(quantity / 20) AS BIGINT) AS trade_id) FROM fx_trades"


@query(f"""SELECT * FROM ({COARSE}) QUALIFY row_number() OVER (
  PARTITION BY instrument_id, trading_day, trade_id ORDER BY ts, side, price, quantity) = 1""")
def dedup_trades_day_key(fx: Fixtures) -> DataFrame:
    return dedup.first_per_key(_coarse(fx), TRADES.day_key, ["ts", *TRADES.rest])


@query(f"""SELECT * FROM fx_levels QUALIFY row_number() OVER (PARTITION BY instrument_id, trading_day, update_seq ORDER BY ts, {LEVEL_REST}) = 1""")
def dedup_levels_day_key(fx: Fixtures) -> DataFrame:
    return dedup.first_per_key(fx.levels(), LEVELS.day_key, ["ts", *LEVELS.rest])


@query("""SELECT * FROM fx_trades t WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM fx_trades WHERE side <> 0) h
  WHERE h.instrument_id = t.instrument_id AND h.ts = t.ts AND h.trade_id = t.trade_id)""")
def new_trades_only(fx: Fixtures) -> DataFrame:
    held = fx.trades().filter("side <> 0")
    return dedup.new_rows(fx.trades(), held, TRADES.key, TRADES.rest)


@query(f"""WITH first AS (SELECT * FROM fx_levels QUALIFY row_number() OVER (PARTITION BY instrument_id, ts, update_seq ORDER BY {LEVEL_REST}) = 1)
SELECT * FROM first t WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM fx_levels WHERE is_snapshot) h
  WHERE h.instrument_id = t.instrument_id AND h.ts = t.ts AND h.update_seq = t.update_seq)""")
def new_levels_only(fx: Fixtures) -> DataFrame:
    return dedup.new_rows(fx.levels(), fx.levels().filter("is_snapshot"), LEVELS.key, LEVELS.rest)


@query(f"""WITH coarse AS ({COARSE}), first AS (SELECT * FROM coarse QUALIFY row_number() OVER (
  PARTITION BY instrument_id, trading_day, trade_id ORDER BY ts, side, price, quantity) = 1)
SELECT * FROM first t WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM coarse WHERE side = 1) h
  WHERE h.instrument_id = t.instrument_id AND h.trading_day = t.trading_day AND h.trade_id = t.trade_id)""")
def merge_trades_day_key(fx: Fixtures) -> DataFrame:
    rows = _coarse(fx)
    return dedup.new_rows(rows, rows.filter("side = 1"), TRADES.day_key, ["ts", *TRADES.rest])


@query(f"""WITH first AS (SELECT * FROM fx_levels QUALIFY row_number() OVER (
  PARTITION BY instrument_id, trading_day, update_seq ORDER BY ts, {LEVEL_REST}) = 1)
SELECT * FROM first t WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM fx_levels WHERE side = 1) h
  WHERE h.instrument_id = t.instrument_id AND h.trading_day = t.trading_day AND h.update_seq = t.update_seq)""")
def merge_levels_day_key(fx: Fixtures) -> DataFrame:
    held = fx.levels().filter("side = 1")
    return dedup.new_rows(fx.levels(), held, LEVELS.day_key, ["ts", *LEVELS.rest])


@query("""SELECT b.instrument_id, b.ts, b.update_seq, b.copies, h.instrument_id IS NOT NULL AS in_target FROM (
  SELECT instrument_id, ts, update_seq, count(*) AS copies FROM fx_levels WHERE NOT is_snapshot GROUP BY 1, 2, 3) b
LEFT JOIN (SELECT DISTINCT instrument_id, ts, update_seq FROM fx_levels WHERE is_snapshot) h
  ON h.instrument_id = b.instrument_id AND h.ts = b.ts AND h.update_seq = b.update_seq
WHERE b.copies > 1 OR h.instrument_id IS NOT NULL""")
def strict_conflicts(fx: Fixtures) -> DataFrame:
    rows = fx.levels()
    return dedup.conflicting_keys(rows.filter("not is_snapshot"), rows.filter("is_snapshot"), LEVELS.key)


@query("""SELECT instrument_id, ts, update_seq, count(*) AS copies FROM fx_levels GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def repeated_keys(fx: Fixtures) -> DataFrame:
    return dedup.repeated_keys(fx.levels(), LEVELS.key)


# ---- loads into tables ------------------------------------------------------------------------------------------------
BUCKETS = 1


def _stored(fx: Fixtures, spec, path: str) -> DataFrame:
    rows = facts.read_feed(fx.spark, spec, path).drop("instr_bucket")
    return rows.withColumn("instrument_id", F.col("instrument_id").cast("bigint"))


@query("SELECT * FROM fx_trades WHERE price > 0 AND quantity >= 0")
def load_trades(fx: Fixtures) -> DataFrame:
    """A first load of some trades, then of all of them: the second adds what is missing. Invalid rows are reported."""
    path = new_folder(fx.spark, "load-trades")
    names = fx.instruments().withColumn("instrument_id", F.col("instrument_id").cast("string"))
    rows = as_stored(fx.trades())
    for batch in (rows.filter("side <> 0"), rows):
        load.append_trades(batch, path, catalog=names, on_invalid="reject", buckets=BUCKETS)
    return _stored(fx, TRADES, path)


@query(f"""WITH held AS (SELECT * FROM fx_month WHERE is_snapshot QUALIFY row_number() OVER (PARTITION BY instrument_id, ts, update_seq ORDER BY {LEVEL_REST}) = 1)
SELECT * FROM held UNION ALL SELECT * FROM (
  SELECT * FROM fx_month t WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.instrument_id = t.instrument_id AND h.ts = t.ts AND h.update_seq = t.update_seq)
  QUALIFY row_number() OVER (PARTITION BY instrument_id, ts, update_seq ORDER BY {LEVEL_REST}) = 1)""")
def load_level_updates(fx: Fixtures) -> DataFrame:
    """A first load of the snapshots, then of all level updates, by day and two buckets."""
    path = new_folder(fx.spark, "load-levels")
    rows = fx.month_levels()
    for batch in (rows.filter("is_snapshot"), rows):
        load.append_level_updates(batch, path, on_invalid="reject", buckets=2)
    return facts.read_feed(fx.spark, LEVELS, path).drop("instr_bucket")


@query(f"""WITH held AS (SELECT * FROM fx_month WHERE is_snapshot QUALIFY row_number() OVER (PARTITION BY instrument_id, trading_day, update_seq ORDER BY ts, {LEVEL_REST}) = 1)
SELECT * FROM held UNION ALL SELECT * FROM (
  SELECT * FROM fx_month t WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.instrument_id = t.instrument_id AND h.trading_day = t.trading_day AND h.update_seq = t.update_seq)
  QUALIFY row_number() OVER (PARTITION BY instrument_id, trading_day, update_seq ORDER BY ts, {LEVEL_REST}) = 1)""")
def merge_levels_by_day(fx: Fixtures) -> DataFrame:
    path = new_folder(fx.spark, "merge-levels")
    rows = fx.month_levels()
    for batch in (rows.filter("is_snapshot"), rows):
        load.merge_level_updates_by_day(batch, path, on_invalid="reject", buckets=2)
    return facts.read_feed(fx.spark, LEVELS, path).drop("instr_bucket")


@query("""SELECT CAST(load AS BIGINT) AS load, n AS received, CASE load WHEN 1 THEN good ELSE 0 END AS inserted,
  CASE load WHEN 1 THEN 0 ELSE good END AS skipped, n - good AS rejected
FROM (SELECT count(*) AS n, count(*) FILTER (price > 0 AND quantity >= 0) AS good FROM fx_trades) CROSS JOIN (VALUES (1), (2)) l(load)""")
def reload_is_noop(fx: Fixtures) -> DataFrame:
    path = new_folder(fx.spark, "reload")
    counts = []
    for number in (1, 2):
        report = load.append_trades(as_stored(fx.trades()), path, on_invalid="reject", buckets=BUCKETS)
        counts.append((number, report.received, report.inserted, report.skipped, report.rejected))
    columns = "load bigint, received bigint, inserted bigint, skipped bigint, rejected bigint"
    return fx.spark.createDataFrame(counts, columns)


@query(f"""WITH coarse AS ({COARSE} WHERE price > 0 AND quantity >= 0),
held AS (SELECT * FROM coarse WHERE side = 1 QUALIFY row_number() OVER (PARTITION BY instrument_id, trading_day, trade_id ORDER BY ts, side, price, quantity) = 1)
SELECT * FROM held UNION ALL SELECT * FROM (
  SELECT * FROM coarse t WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.instrument_id = t.instrument_id AND h.trading_day = t.trading_day AND h.trade_id = t.trade_id)
  QUALIFY row_number() OVER (PARTITION BY instrument_id, trading_day, trade_id ORDER BY ts, side, price, quantity) = 1)""")
def merge_trades_by_day(fx: Fixtures) -> DataFrame:
    path = new_folder(fx.spark, "merge-trades")
    rows = as_stored(_coarse(fx))
    for batch in (rows.filter("side = 1"), rows):
        load.merge_trades_by_day(batch, path, on_invalid="reject", buckets=BUCKETS)
    return _stored(fx, TRADES, path)


LANDED_SQL = """SELECT exchange, symbol, timestamp, local_timestamp, id, side, price, amount, 'trades' AS feed,
  file_day AS trading_day, venue, dataset FROM raw_trades"""


@query(LANDED_SQL)
def land_raw(fx: Fixtures) -> DataFrame:
    """Landed twice: the second landing finds everything there."""
    path = new_folder(fx.spark, "landed")
    rows = landing.landed_rows(fx.raw_trades(), TRADES, F.col("venue"), F.col("file_day"))
    for _ in range(2):
        landing.land_raw(rows, path)
    return landing.read_landed(fx.spark, TRADES, path).drop(*landing.ORIGIN)


@query(LANDED_SQL)
def land_two_datasets(fx: Fixtures) -> DataFrame:
    """Half of the data sets of every venue and day landed in one call, the others in a second, which is repeated."""
    path = new_folder(fx.spark, "landed")
    rows = landing.landed_rows(fx.raw_trades(), TRADES, F.col("venue"), F.col("file_day"))
    other = F.pmod(F.crc32(F.col("dataset").cast("binary")), F.lit(2)) == 1
    for part in (rows.filter(~other), rows.filter(other), rows.filter(other)):
        landing.land_raw(part, path)
    return landing.read_landed(fx.spark, TRADES, path).drop(*landing.ORIGIN)


@query("""SELECT exchange, symbol, timestamp, local_timestamp, id, side, price, amount, 'trades' AS feed,
  file_day AS trading_day, venue, dataset FROM raw_trades WHERE side = 'buy' OR instrument_id % 2 = 0""")
def land_changed(fx: Fixtures) -> DataFrame:
    """Landed: the buys; a landing that broke off before its entry; then all rows of half the data sets, of which those with other
    trades than buys are written anew; then what nobody reads is removed."""
    path = new_folder(fx.spark, "landed")
    raw = fx.raw_trades()
    delivered = [raw.filter("side = 'buy'"), raw, raw.filter("instrument_id % 2 = 0")]
    first, broken, second = [landing.landed_rows(rows, TRADES, F.col("venue"), F.col("file_day")) for rows in delivered]
    landing.land_raw(first, path)
    landing.write_rows(broken, path, "broken")
    landing.land_raw(second, path)
    landing.fold_landed(fx.spark, TRADES, path)
    return landing.read_landed(fx.spark, TRADES, path).drop(*landing.ORIGIN)


@query("""WITH d AS (SELECT count(DISTINCT (venue, dataset, file_day)) AS n,
  count(DISTINCT (venue, dataset, file_day)) FILTER (instrument_id % 3 = 0) AS third FROM raw_trades)
SELECT CAST(landing AS BIGINT) AS landing, CASE landing WHEN 1 THEN n WHEN 2 THEN 0 ELSE third END AS written,
  CASE landing WHEN 1 THEN 0 WHEN 2 THEN n ELSE n - third END AS unchanged FROM d CROSS JOIN (VALUES (1), (2), (3)) l(landing)""")
def landing_counts(fx: Fixtures) -> DataFrame:
    """Data set days written and left alone by a landing, by the same again, and by one with other amounts in a third of them."""
    path = new_folder(fx.spark, "landed")
    raw = fx.raw_trades()
    other = raw.withColumn("amount", F.when(F.col("instrument_id") % 3 == 0, (F.col("amount") + 1).cast(PRICE)).otherwise(F.col("amount")))
    counts = []
    for number, rows in enumerate((raw, raw, other), 1):
        done = landing.land_raw(landing.landed_rows(rows, TRADES, F.col("venue"), F.col("file_day")), path)
        counts.append((number, done.written, done.unchanged))
    return fx.spark.createDataFrame(counts, "landing bigint, written bigint, unchanged bigint")


@query("""SELECT 'binance-futures' AS exchange, 'lvl' || CAST(l_suppkey % 5 AS VARCHAR) AS symbol, timestamp,
  timestamp + l_linenumber AS local_timestamp, l_linestatus = 'F' AS is_snapshot,
  CASE l_returnflag WHEN 'R' THEN 'bid' WHEN 'A' THEN 'ask' ELSE 'BID' END AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  place AS line, 'l2' AS feed, CAST(day AS VARCHAR) AS trading_day, 'BinanceFutures' AS venue, dataset FROM level_files""")
def land_requested(fx: Fixtures) -> DataFrame:
    """Delivered files landed by request, some of them twice; every row keeps its place in its file."""
    lake = _delivered(fx)
    requests = _level_requests(fx)
    for part in (requests.filter("instrument_id IN ('i0', 'i1')"), requests):
        lake.land(part, LEVELS.name)
    rows = landing.read_landed(fx.spark, LEVELS, lake.landed(LEVELS.name))
    first = rows.groupBy("_file").agg(F.min("_arrival").alias("_first"))
    return rows.join(first, "_file").withColumn("line", F.col("_arrival") - F.col("_first")).drop("_file", "_arrival", "_first")


@query("""WITH d AS (SELECT count(DISTINCT (dataset, day)) AS n, count(DISTINCT (dataset, day)) FILTER (dataset IN ('LVL0', 'LVL1')) AS part FROM level_files)
SELECT CAST(landing AS BIGINT) AS landing, CASE landing WHEN 1 THEN part WHEN 2 THEN n - part ELSE 0 END AS written, CAST(0 AS BIGINT) AS unchanged,
  CASE landing WHEN 1 THEN 0 WHEN 2 THEN part ELSE n END AS skipped FROM d CROSS JOIN (VALUES (1), (2), (3)) l(landing)""")
def land_requested_counts(fx: Fixtures) -> DataFrame:
    """What three landings by request write and skip: files landed before aren't read again."""
    lake = _delivered(fx)
    requests = _level_requests(fx)
    counts = []
    for number, part in enumerate((requests.filter("instrument_id IN ('i0', 'i1')"), requests, requests), 1):
        done = lake.land(part, LEVELS.name)
        counts.append((number, done.written, done.unchanged, done.skipped))
    return fx.spark.createDataFrame(counts, "landing bigint, written bigint, unchanged bigint, skipped bigint")


def _delivered(fx: Fixtures) -> Lake:
    """A lake with two buckets over the delivered files of five data sets."""
    base = new_folder(fx.spark, "lake")
    fx.deliver_levels(f"{base}/delivered")
    fx.level_catalog().write.partitionBy("exchange").parquet(f"{base}/lake/instruments")
    return Lake(fx.spark, f"{base}/lake", f"{base}/delivered", buckets=2)


def _level_requests(fx: Fixtures) -> DataFrame:
    """Every instrument and day of the delivered month, and an instrument nobody knows."""
    ids = fx.level_catalog().select("instrument_id").unionByName(fx.spark.createDataFrame([("nobody",)], "instrument_id string"))
    return ids.withColumn("trading_day", coverage.calendar(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 28))))


@query("""SELECT make_timestamp(timestamp) AS ts, instrument_id, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS BIGINT) AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
  l_linestatus = 'F' AS is_snapshot, place AS update_seq, CAST(day AS VARCHAR) AS trading_day FROM level_files""")
def load_levels_from_files(fx: Fixtures) -> DataFrame:
    """Delivered gzip text to the fact table, in two loads that overlap: parsed, numbered by arrival, appended by day and bucket."""
    lake = _delivered(fx)
    requests = _level_requests(fx)
    for part in (requests.filter("instrument_id IN ('i0', 'i1')"), requests):
        lake.load_level_updates(part)
    return lake.facts(LEVELS)


@query("""SELECT 'i' || CAST(n AS VARCHAR) AS instrument_id, 'LVL' || CAST(n AS VARCHAR) AS dataset, CAST(CAST(d AS DATE) AS VARCHAR) AS trading_day, n <> 4 AS expected
FROM (SELECT unnest(range(5)) AS n) CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS d)
WHERE NOT EXISTS (SELECT 1 FROM level_files f WHERE f.dataset = 'LVL' || CAST(n AS VARCHAR) AND f.day = CAST(d AS DATE)) AND (d < TIMESTAMP '2024-02-01' OR n <> 4)
UNION ALL SELECT 'i4', 'LVL4', CAST(CAST(d AS DATE) AS VARCHAR), true FROM (SELECT unnest(generate_series(TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS d)""")
def load_gaps(fx: Fixtures) -> DataFrame:
    """The instrument-days without a file that a load reports; those before an instrument was available are not expected."""
    lake = _delivered(fx)
    days = coverage.calendar(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 2, 5)))
    requests = fx.level_catalog().select("instrument_id", days.alias("trading_day"))
    return lake.load_level_updates(requests).absent


@query("""SELECT exchange, symbol, timestamp, local_timestamp, is_snapshot, side, price, amount FROM (
SELECT 'binance-futures' AS exchange, lower(dataset) AS symbol, timestamp, timestamp + l_linenumber AS local_timestamp, l_linestatus = 'F' AS is_snapshot,
  CASE l_returnflag WHEN 'R' THEN 'bid' WHEN 'A' THEN 'ask' ELSE 'BID' END AS side, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS amount, place FROM level_files WHERE dataset = 'LVL2' AND day = DATE '2024-01-09' ORDER BY place LIMIT 20 OFFSET 5)""")
def page_source_file(fx: Fixtures) -> DataFrame:
    """Twenty lines straight from a delivered file."""
    return _delivered(fx).page_level_updates("BinanceFutures", "lvl2", "2024-01-09", 20, 5).drop("_file", "_arrival")


@query("SELECT * FROM fx_trades WHERE side <> 0 AND price > 0 AND quantity >= 0")
def load_all_or_nothing(fx: Fixtures) -> DataFrame:
    """A batch with invalid rows is refused as a whole: the table stays as the load before left it."""
    path = new_folder(fx.spark, "all-or-nothing")
    rows = as_stored(fx.trades())
    load.append_trades(rows.filter("side <> 0"), path, on_invalid="reject", buckets=BUCKETS)
    bad = rows.withColumn("price", F.when(F.col("side") == 0, F.lit(-1).cast(PRICE)).otherwise(F.col("price")))
    try:
        load.append_trades(bad, path, on_invalid="fail", buckets=BUCKETS)
    except load.LoadRejected:
        pass
    return _stored(fx, TRADES, path)


@query("SELECT * FROM fx_trades WHERE price > 0 AND quantity >= 0")
def load_after_rejected_first(fx: Fixtures) -> DataFrame:
    """A first load that is refused leaves no table, so the next one may choose another number of buckets."""
    path = new_folder(fx.spark, "first-load")
    rows = as_stored(fx.trades())
    bad = rows.withColumn("price", F.when(F.col("side") == 0, F.lit(-1).cast(PRICE)).otherwise(F.col("price")))
    try:
        load.append_trades(bad, path, on_invalid="fail", buckets=BUCKETS + 2)
    except load.LoadRejected:
        pass
    load.append_trades(rows, path, on_invalid="reject", buckets=BUCKETS)
    return _stored(fx, TRADES, path)


@query("""SELECT DISTINCT 'okx-futures' AS slug, 'future' AS instrument_type, upper(venue) AS dataset, file_day, 'trades' AS tag FROM raw_trades""")
def cache_listing(fx: Fixtures) -> DataFrame:
    """What the cache tree holds, from the names of its files."""
    base = new_folder(fx.spark, "cache")
    fx.write_cache(f"{base}/cache", "okx-futures", "future")
    return raw_files.list_cache(fx.spark, f"{base}/cache").drop("path", "length").distinct()


NORMALIZED_SQL = """SELECT ts, instrument_id, CAST(CASE side WHEN 'buy' THEN 1 WHEN 'sell' THEN -1 ELSE 0 END AS BIGINT) AS side,
  price, amount AS quantity, id AS trade_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS trading_day
FROM raw_trades WHERE timestamp IS NOT NULL AND price > 0 AND amount >= 0"""


def _landed_csv(fx: Fixtures, path: str) -> None:
    rows = landing.landed_rows(fx.raw_trades(), TRADES, F.col("venue"), F.col("file_day"))
    landing.export_text(rows, path)


@query(NORMALIZED_SQL)
def ingest_new_files(fx: Fixtures) -> DataFrame:
    """Landed text files picked up by a stream; a second pass finds nothing new."""
    base = new_folder(fx.spark, "ingest")
    _landed_csv(fx, f"{base}/landed")
    names = facts.dataset_map(fx.instruments()).withColumn("instrument_id", F.col("instrument_id").cast("string"))
    for _ in range(2):
        ingest.ingest_new_files(
            fx.spark, TRADES, f"{base}/landed", names, f"{base}/trades", f"{base}/checkpoint",
            on_invalid="reject", buckets=BUCKETS
        ).awaitTermination()
    return _stored(fx, TRADES, f"{base}/trades")


def _half_known(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Data sets of the instruments with even ids, and of all of them."""
    names = facts.dataset_map(fx.instruments())
    return tuple(rows.withColumn("instrument_id", F.col("instrument_id").cast("string")) for rows in (names.filter("instrument_id % 2 = 0"), names))


@query(NORMALIZED_SQL)
def ingest_learned_instruments(fx: Fixtures) -> DataFrame:
    """The catalog learns half of the data sets after the first pass; the second takes what was held back."""
    base = new_folder(fx.spark, "ingest")
    _landed_csv(fx, f"{base}/landed")
    for names in _half_known(fx):
        ingest.ingest_new_files(
            fx.spark, TRADES, f"{base}/landed", names, f"{base}/trades", f"{base}/checkpoint",
            on_invalid="reject", buckets=BUCKETS
        ).awaitTermination()
    return _stored(fx, TRADES, f"{base}/trades")


@query("""SELECT exchange, upper(symbol) AS dataset, CASE WHEN instrument_id % 2 = 0 THEN 'loaded' ELSE 'held' END AS state,
  count(timestamp) AS rows, count(timestamp) FILTER (instrument_id % 2 = 0 AND NOT (price > 0 AND amount >= 0)) AS invalid,
  count(DISTINCT file_day) FILTER (timestamp IS NOT NULL) AS days
FROM raw_trades GROUP BY ALL HAVING count(timestamp) > 0""")
def pick_up_states(fx: Fixtures) -> DataFrame:
    """What a pickup notes of the files, by data set: the rows of those that the catalog lacks are held back."""
    base = new_folder(fx.spark, "pick-up")
    _landed_csv(fx, f"{base}/landed")
    ledger.pick_up(fx.spark, TRADES, f"{base}/landed", _half_known(fx)[0], f"{base}/trades", on_invalid="reject", buckets=BUCKETS)
    states = ledger.file_states(fx.spark, f"{base}/trades")
    day = F.regexp_extract("path", r"trading_day=(\d{4}-\d{2}-\d{2})", 1)
    return states.groupBy(*ledger.DATASET, "state").agg(F.sum("rows").alias("rows"), F.sum("invalid").alias("invalid"), F.count_distinct(day).alias("days"))


@query("""SELECT make_timestamp(timestamp) AS ts, instrument_id, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS BIGINT) AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
  l_linestatus = 'F' AS is_snapshot, place AS update_seq, CAST(day AS VARCHAR) AS trading_day FROM level_files""")
def pick_up_levels(fx: Fixtures) -> DataFrame:
    """Delivered files of level updates, picked up in three passes of which the first knows two data sets and the last finds nothing."""
    base = new_folder(fx.spark, "pick-up")
    fx.deliver_levels(f"{base}/delivered")
    names = facts.dataset_map(fx.level_catalog())
    for known in (names.filter("dataset IN ('LVL1', 'LVL3')"), names, names):
        ledger.pick_up(fx.spark, LEVELS, f"{base}/delivered", known, f"{base}/levels", sequence="arrival", buckets=2)
    return facts.read_feed(fx.spark, LEVELS, f"{base}/levels").drop("instr_bucket")


@query("""SELECT ts, r.instrument_id, CAST(CASE side WHEN 'buy' THEN 1 WHEN 'sell' THEN -1 ELSE 0 END AS BIGINT) AS side,
  price, amount AS quantity, id AS trade_id, file_day AS trading_day
FROM raw_trades r JOIN fx_instruments i ON i.instrument_id = r.instrument_id
WHERE timestamp IS NOT NULL AND price > 0 AND amount >= 0 AND file_day BETWEEN '2024-01-01' AND '2024-01-31'""")
def load_by_request(fx: Fixtures) -> DataFrame:
    """The trades of every instrument-day of the month, requested by identity and loaded from raw rows."""
    path = new_folder(fx.spark, "by-request")
    names = fx.instruments().withColumn("instrument_id", F.col("instrument_id").cast("string"))
    requests = _daily(spread(names.select(*IDENTITY), *IDENTITY))
    raw = fx.raw_trades().drop("instrument_id")
    load.load_trades(requests, names, raw, path, on_invalid="reject", buckets=BUCKETS)
    return _stored(fx, TRADES, path)


@query(f"""SELECT ts, instrument_id, CAST(CASE side WHEN 'bid' THEN 1 WHEN 'ask' THEN -1 ELSE 0 END AS BIGINT) AS side, price,
  amount AS quantity, is_snapshot, row_number() OVER (PARTITION BY instrument_id, file_day {SORTED}) AS update_seq, file_day AS trading_day
FROM raw_levels""")
def requested_levels(fx: Fixtures) -> DataFrame:
    """What a load by request writes: the level updates of all instruments, requested by id, numbered per data set and day."""
    key = F.col("s_suppkey").cast("string")
    names = fx.table("supplier").select(
        key.alias("instrument_id"),
        F.concat(F.lit("l"), key).alias("dataset"),
        *[F.lit("any").alias(c) for c in IDENTITY],
    )
    days = coverage.calendar(F.lit(dt.date(1995, 1, 1)), F.lit(dt.date(2001, 12, 31)))
    requests = spread(names.select("instrument_id"), "instrument_id").select("instrument_id", days.alias("trading_day"))
    raw = fx.raw_levels().drop("instrument_id").withColumn("dataset", F.upper("symbol"))
    rows = load.for_requests(raw, load.requested_instruments(requests, names))
    levels = normalize.normalize_levels(load.numbered_levels(rows, "sorted", ["dataset", "file_day"]))
    return levels.withColumn("instrument_id", F.col("instrument_id").cast("bigint"))


@query(f"""SELECT * FROM fx_month QUALIFY row_number() OVER (
  PARTITION BY instrument_id, trading_day, update_seq ORDER BY ts, {LEVEL_REST}) = 1""")
def load_strict(fx: Fixtures) -> DataFrame:
    """A strict load of rows without repeated keys, by day and two buckets."""
    path = new_folder(fx.spark, "strict")
    rows = dedup.first_per_key(fx.month_levels(), LEVELS.day_key, ["ts", *LEVELS.rest])
    load.append_strict(rows, LEVELS, path, buckets=2)
    return facts.read_feed(fx.spark, LEVELS, path).drop("instr_bucket")


@query(f"""WITH held AS (SELECT * FROM fx_month WHERE is_snapshot QUALIFY row_number() OVER (PARTITION BY instrument_id, ts, update_seq ORDER BY {LEVEL_REST}) = 1),
single AS (SELECT * FROM fx_month QUALIFY count(*) OVER (PARTITION BY instrument_id, ts, update_seq) = 1)
SELECT * FROM held UNION ALL SELECT s.* FROM single s ANTI JOIN held h ON s.instrument_id = h.instrument_id AND s.ts = h.ts AND s.update_seq = h.update_seq""")
def load_strict_conflicts(fx: Fixtures) -> DataFrame:
    """A strict load that meets stored and repeated keys is refused as a whole; without the rows of those keys it goes in."""
    path = new_folder(fx.spark, "strict")
    rows = fx.month_levels()
    load.append_strict(dedup.first_per_key(rows.filter("is_snapshot"), LEVELS.key, LEVELS.rest), LEVELS, path, buckets=2)
    held = facts.read_feed(fx.spark, LEVELS, path).drop("instr_bucket")
    conflicts = stage(dedup.conflicting_keys(rows, held, LEVELS.key), "conflicts")
    try:
        load.append_strict(rows, LEVELS, path, buckets=2)
    except load.LoadRejected:
        pass
    load.append_strict(rows.join(conflicts.select(*LEVELS.key), LEVELS.key, "left_anti").select(*rows.columns), LEVELS, path, buckets=2)
    return facts.read_feed(fx.spark, LEVELS, path).drop("instr_bucket")


@query("""SELECT DISTINCT instrument_id, ts, update_seq FROM fx_levels""")
def unique_stream(fx: Fixtures) -> DataFrame:
    """Keys of an endless stream of level updates, each once."""
    base = new_folder(fx.spark, "unique")
    rows = as_stored(fx.levels()).select(*LEVELS.key)
    rows.write.parquet(f"{base}/in")
    stream = fx.spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    rows_once = unique.unique_stream(stream, LEVELS.key).writeStream.format("parquet").option("path", f"{base}/out")
    rows_once.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    stored = fx.spark.read.schema(rows.schema).parquet(f"{base}/out")
    return stored.withColumn("instrument_id", F.col("instrument_id").cast("bigint"))


@query("""SELECT DISTINCT instrument_id, ts, update_seq FROM fx_month""")
def unique_stream_late(fx: Fixtures) -> DataFrame:
    """The table of an endless stream in several batches, newest rows first, all of them delivered twice, then by a stream begun anew."""
    base = new_folder(fx.spark, "unique")
    rows = as_stored(fx.month_levels()).select(*LEVELS.key)
    for part in (F.dayofmonth("ts") % 2 == 0, F.dayofmonth("ts") % 2 == 1, F.lit(True)):
        rows.where(part).coalesce(max(2, fx.spark.sparkContext.defaultParallelism)).write.mode("append").parquet(f"{base}/in")
    written = len([name for name in child_names(fx.spark, f"{base}/in") if name.startswith("part-")])
    for k, files in enumerate((max(3, written // 2), max(100, written))):
        stream = fx.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")
        unique.write_unique(stream, LEVELS.key, f"{base}/out", f"{base}/checkpoint{k}", once=True).awaitTermination()
    return unique.read_unique(fx.spark, f"{base}/out")


@query("""SELECT ts, venue AS dataset, CAST(CASE side WHEN 'buy' THEN 1 WHEN 'sell' THEN -1 ELSE 0 END AS BIGINT) AS side,
  price, amount AS quantity, id AS trade_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS trading_day
FROM raw_trades WHERE timestamp IS NOT NULL AND price > 0 AND amount >= 0 AND venue <> 'KucoinSpot'""")
def import_cache(fx: Fixtures) -> DataFrame:
    """A cache tree with one folder per venue, imported by a catalog that knows all of them but one."""
    base = new_folder(fx.spark, "cache")
    fx.write_cache(f"{base}/cache", "okx-futures", "future")
    venue = fx.instruments().select("exchange").distinct()
    names = venue.filter("exchange <> 'KucoinSpot'").select(
        F.col("exchange").alias("instrument_id"),
        F.col("exchange").alias("dataset"),
        F.lit("OkexFutures").alias("exchange"),
        F.lit("future").alias("instrument_type"),
    )
    tables = {TRADES.name: f"{base}/trades", LEVELS.name: f"{base}/levels"}
    importing.import_cache(
        fx.spark, f"{base}/cache", names, "OkexFutures", "future", tables, start=FIRST, end=dt.date(2024, 2, 10),
        on_invalid="reject", buckets=BUCKETS,
    )
    rows = facts.read_feed(fx.spark, TRADES, f"{base}/trades")
    return rows.withColumnRenamed("instrument_id", "dataset").drop("instr_bucket")


@query("""SELECT make_timestamp(timestamp) AS ts, dataset, CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS BIGINT) AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
  l_linestatus = 'F' AS is_snapshot, row_number() OVER (PARTITION BY dataset, day ORDER BY timestamp, l_linenumber,
    CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_quantity AS DECIMAL(18,2)),
    CASE l_returnflag WHEN 'R' THEN 'bid' WHEN 'A' THEN 'ask' ELSE 'BID' END, l_linestatus = 'F') AS update_seq,
  CAST(day AS VARCHAR) AS trading_day FROM level_files WHERE dataset <> 'LVL2'""")
def import_cache_levels(fx: Fixtures) -> DataFrame:
    """A cache tree with files of level updates, imported twice and numbered in sorted order; the catalog lacks one data set."""
    base = new_folder(fx.spark, "cache")
    fx.write_level_cache(f"{base}/cache", "okx-futures", "future")
    known = fx.level_catalog().filter("dataset <> 'LVL2'")
    names = known.select(F.col("dataset").alias("instrument_id"), "dataset", F.lit("OkexFutures").alias("exchange"), F.lit("future").alias("instrument_type"))
    tables = {TRADES.name: f"{base}/trades", LEVELS.name: f"{base}/levels"}
    for _ in range(2):
        importing.import_cache(
            fx.spark, f"{base}/cache", names, "OkexFutures", "future", tables, start=FIRST, end=LAST, on_invalid="reject", buckets=2
        )
    rows = facts.read_feed(fx.spark, LEVELS, f"{base}/levels")
    return rows.withColumnRenamed("instrument_id", "dataset").drop("instr_bucket")


@query("SELECT * FROM fx_trades")
def compact_cold(fx: Fixtures) -> DataFrame:
    path = new_folder(fx.spark, "compact")
    rows = as_stored(fx.trades())
    for part in (rows.filter("side = 0"), rows.filter("side <> 0")):
        layout.write_layout(part, path, buckets=BUCKETS)
    maintenance.compact_cold(fx.spark, path, as_of="2024-01-31", buckets=BUCKETS)
    return _stored(fx, TRADES, path)


@query("SELECT * FROM fx_trades WHERE side <> -1 OR (price > 0 AND quantity >= 0)")
def compact_broken_run(fx: Fixtures) -> DataFrame:
    """A compaction whose driver is lost once it is decided; a load into the same days; the next compaction finishes the first."""
    path = new_folder(fx.spark, "compact")
    rows = as_stored(fx.trades())
    for part in (rows.filter("side = 0"), rows.filter("side = 1")):
        layout.write_layout(part, path, buckets=BUCKETS)
    days = maintenance.stored_days(fx.spark, path)[::2]
    old = [file for day in days for file in maintenance.day_files(fx.spark, path, day)]
    maintenance.prepare_compaction(fx.spark, path, old, BUCKETS)
    load.append_trades(rows, path, on_invalid="reject", buckets=BUCKETS)
    maintenance.compact_cold(fx.spark, path, as_of="2024-01-31", buckets=BUCKETS)
    return _stored(fx, TRADES, path)


# ---- catalog writes ---------------------------------------------------------------------------------------------------
@query("""SELECT DISTINCT 'asset' AS dimension, name FROM (
  SELECT base_asset AS name FROM fx_instruments UNION SELECT quote_asset FROM fx_instruments
  UNION SELECT base_asset FROM fx_refresh UNION SELECT quote_asset FROM fx_refresh)
UNION ALL SELECT DISTINCT 'exchange', exchange FROM fx_instruments
UNION ALL SELECT DISTINCT 'symbol', md5(concat_ws('|', base_asset, quote_asset, exchange)) FROM (
  SELECT base_asset, quote_asset, exchange FROM fx_instruments UNION SELECT base_asset, quote_asset, exchange FROM fx_refresh)""")
def ensure_dimensions(fx: Fixtures) -> DataFrame:
    held = fx.instruments()
    exchanges, assets, symbols = catalog.ensure_dimensions(
        fx.refresh_rows(), catalog.exchange_names(held), catalog.asset_names(held), catalog.symbols_of(held)
    )

    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("dimension"), F.col(df.columns[0]).alias("name"))

    return tagged(assets, "asset").unionByName(tagged(exchanges, "exchange")).unionByName(tagged(symbols, "symbol"))


FIELDS = ", ".join(INSTRUMENT_FIELDS)


def _upsert_sql(keys: list[str]) -> str:
    key = ", ".join(keys)
    match = " AND ".join(f"h.{k} = n.{k}" for k in keys)
    fields = ", ".join(f"n.{c}" for c in [*IDENTITY, *INSTRUMENT_FIELDS])
    return f"""WITH last AS (SELECT * FROM fx_refresh QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ordinal DESC) = 1)
SELECT CAST(n.instrument_id AS VARCHAR) AS instrument_id, n.symbol_id, {fields}, 'kept' AS action FROM fx_instruments n
WHERE NOT EXISTS (SELECT 1 FROM last h WHERE {match})
UNION ALL SELECT coalesce(CAST(h.instrument_id AS VARCHAR), md5(concat_ws('|', n.base_asset, n.quote_asset, n.exchange, n.instrument_type))),
  md5(concat_ws('|', n.base_asset, n.quote_asset, n.exchange)), {fields},
  CASE WHEN h.instrument_id IS NULL THEN 'inserted' ELSE 'updated' END
FROM last n LEFT JOIN fx_instruments h ON {match}"""


BY_DATASET = ["exchange", "instrument_type", "dataset"]


@query(_upsert_sql(IDENTITY))
def upsert_instruments(fx: Fixtures) -> DataFrame:
    return catalog.upsert_instruments(fx.instruments(), fx.refresh_rows())


@query(_upsert_sql(BY_DATASET))
def upsert_instruments_by_dataset(fx: Fixtures) -> DataFrame:
    return catalog.upsert_instruments(fx.instruments(), fx.refresh_rows(), BY_DATASET)


def _moved(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """A catalog whose ids are digests, and rows: every third instrument moves to another base asset, a new data set takes its
    identity, and other new data sets claim identities that are held."""
    held = fx.instruments().withColumn("instrument_id", catalog.instrument_id())
    number = F.regexp_extract("base_asset", r"\d+", 0).cast("int")
    rows = held.drop("instrument_id", "symbol_id").withColumn("number", number)
    moved = rows.filter("number % 3 = 0").withColumn("base_asset", F.concat(F.lit("M"), "base_asset"))
    taken = rows.filter("number % 3 = 0").withColumn("dataset", F.concat(F.lit("NEW"), "dataset"))
    claimed = rows.filter("number % 3 = 1").withColumn("dataset", F.concat(F.lit("DUP"), "dataset"))
    return held, moved.unionByName(taken).unionByName(claimed).withColumnRenamed("number", "ordinal")


_DIGEST = "md5(concat_ws('|', base_asset, quote_asset, exchange, instrument_type))"


@query(f"""WITH i AS (SELECT *, {_DIGEST} AS digest, CAST(substr(base_asset, 2) AS INT) AS number FROM fx_instruments)
SELECT digest AS instrument_id, CASE WHEN number % 3 = 0 THEN 'M' ELSE '' END || base_asset AS base_asset, quote_asset, exchange, instrument_type,
  dataset, CASE WHEN number % 3 = 0 THEN 'updated' ELSE 'kept' END AS action FROM i
UNION ALL SELECT md5(concat_ws('|', digest, exchange, instrument_type, 'NEW' || dataset)), base_asset, quote_asset, exchange, instrument_type,
  'NEW' || dataset, 'inserted' FROM i WHERE number % 3 = 0""")
def upsert_moved_instruments(fx: Fixtures) -> DataFrame:
    """Who takes the identity of an instrument that moved gets an id of its own."""
    rows = catalog.upsert_instruments(*_moved(fx), BY_DATASET)
    return rows.select("instrument_id", *IDENTITY, "dataset", "action")


@query("""SELECT exchange, instrument_type, 'DUP' || dataset AS dataset, 'identity is held' AS reason FROM fx_instruments WHERE CAST(substr(base_asset, 2) AS INT) % 3 = 1""")
def upsert_refused(fx: Fixtures) -> DataFrame:
    return catalog.identity_conflicts(*_moved(fx), BY_DATASET)


@query(f"SELECT action, count(*) AS instruments FROM ({_upsert_sql(IDENTITY).replace('WITH last AS (', 'SELECT action FROM (WITH last AS (', 1)})) GROUP BY 1")
def upsert_counts(fx: Fixtures) -> DataFrame:
    return catalog.upsert_counts(catalog.upsert_instruments(fx.instruments(), fx.refresh_rows()))


REFRESHED = """SELECT upper(base) AS base_asset, upper(quote) AS quote_asset, 'OkexSwap' AS exchange,
  CASE WHEN kind IN ('swap', 'perp') THEN 'perpetual' ELSE kind END AS instrument_type, upper(dataset_own) AS dataset,
  coalesce(active, true) AS active, since_ts AS available_since, CAST(price_increment AS DOUBLE) AS price_increment
FROM fx_list WHERE base IS NOT NULL AND dataset_own IS NOT NULL AND kind <> 'option'"""


@query(f"""SELECT md5(concat_ws('|', base_asset, quote_asset, exchange, instrument_type)) AS instrument_id, *
FROM ({REFRESHED}) WHERE price_increment > 0""")
def refresh_instruments(fx: Fixtures) -> DataFrame:
    """An instrument list taken into a catalog table: inserted by the first refresh, updated in place by the second."""
    path = new_folder(fx.spark, "catalog")
    for _ in range(2):
        refresh.refresh_instruments(fx.spark, fx.instrument_list(), "OkexSwap", path)
    rows = facts.read_catalog(fx.spark, path)
    return rows.select("instrument_id", *IDENTITY, "dataset", "active", "available_since", "price_increment")


@query(f"""SELECT md5(concat_ws('|', base_asset, quote_asset, exchange, instrument_type)) AS instrument_id, *
FROM ({REFRESHED}) WHERE price_increment > 0""")
def refresh_from_list(fx: Fixtures) -> DataFrame:
    """The same list read from JSON files."""
    base = new_folder(fx.spark, "list")
    fx.write_list(f"{base}/list")
    refresh.refresh_instruments(fx.spark, raw_files.read_instruments(fx.spark, f"{base}/list", "OkexSwap"), "OkexSwap", f"{base}/catalog")
    rows = facts.read_catalog(fx.spark, f"{base}/catalog")
    return rows.select("instrument_id", *IDENTITY, "dataset", "active", "available_since", "price_increment")


@query(f"SELECT dataset, 'price increment' AS reason FROM ({REFRESHED}) WHERE price_increment <= 0")
def refresh_rejects(fx: Fixtures) -> DataFrame:
    return refresh.refresh_rejects(fx.instrument_list()).select("dataset", "reason")


# ---- manifest and reports ---------------------------------------------------------------------------------------------
TAGS = "(VALUES ('trades', 'trades'), ('l2', 'incremental_book_L2')) f(tag, segment)"
MANIFEST = f"""SELECT i.dataset, i.instrument_type, CAST(d.d AS VARCHAR) AS trading_day, f.tag,
  'v1/' || {SLUG} || '/' || f.segment || '/' || strftime(d.d, '%Y/%m/%d') || '/' || i.dataset || '.csv.gz' AS source,
  {SLUG} || '/' || i.instrument_type || '/' || upper(i.dataset) || '/' || lower(i.base_asset) || '_' || CAST(d.d AS VARCHAR) || '_' || f.tag || '.csv.gz' AS cache
FROM fx_instruments i CROSS JOIN (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', INTERVAL 1 DAY)) AS DATE) AS d) d CROSS JOIN {TAGS}
WHERE (i.listing IS NULL OR d.d >= CAST(i.listing AS DATE)) AND (i.expiration IS NULL OR d.d < CAST(i.expiration AS DATE))"""


def _manifest(fx: Fixtures) -> DataFrame:
    listed = fx.instruments().select(
        "dataset",
        F.col("base_asset").alias("symbol"),
        "instrument_type",
        F.to_date("listing").alias("since"),
        F.to_date("expiration").alias("to"),
        "exchange",
    )
    return manifest.download_manifest(
        listed, venues.exchange_slug(F.col("exchange")), start="2024-01-10", end="2024-01-20"
    )


@query(MANIFEST)
def download_manifest(fx: Fixtures) -> DataFrame:
    return _manifest(fx)


@query(f"""SELECT m.* FROM ({MANIFEST}) m WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT i.dataset, t.trading_day, count(*) AS n FROM fx_trades t JOIN fx_instruments i ON i.instrument_id = t.instrument_id GROUP BY 1, 2) c
  WHERE m.tag = 'trades' AND c.n > 1 AND c.dataset = m.dataset AND c.trading_day = m.trading_day)""")
def manifest_remaining(fx: Fixtures) -> DataFrame:
    """A day with trades counts as a cached file; a day with a single trade as an empty one."""
    days = coverage.feed_days(fx.trades(), TRADES.name).join(fx.instruments(), "instrument_id")
    slug = venues.exchange_slug(F.col("exchange"))
    name = locations.cache_location(
        slug, F.col("instrument_type"), F.col("dataset"), F.col("base_asset"), F.col("trading_day"), F.lit("trades")
    )
    listing = days.select(name.alias("cache"), (F.col("items_count") - 1).alias("length"))
    return manifest.remaining(_manifest(fx), listing)


@query("""SELECT CAST(ordinal AS BIGINT) AS ordinal, dataset, symbol, instrument_type, since, "to" FROM (SELECT ordinal,
  coalesce(dataset_own, trim(symbol)) AS dataset,
  coalesce(lower(trim(symbol)), dataset_own, 'unknown') AS symbol, kind AS instrument_type,
  CAST(CAST(since_ts AS DATE) AS VARCHAR) AS since, CAST(to_day AS VARCHAR) AS "to" FROM fx_list) WHERE dataset IS NOT NULL""")
def listed_instruments(fx: Fixtures) -> DataFrame:
    listed = fx.instrument_list()
    rows = manifest.listed_instruments(listed.withColumn("exchange", F.col("ordinal").cast("string")))
    return rows.select(F.col("exchange").cast("bigint").alias("ordinal"), "dataset", "symbol", "instrument_type", "since", "to")


@query(f"""SELECT i.dataset, {SLUG} AS slug, i.instrument_type, t.trading_day AS file_day, 'trades' AS tag,
  'cache/' || {SLUG} || '/' || i.instrument_type || '/' || i.dataset || '/' || lower(i.base_asset) || '_' || t.trading_day || '_trades.csv.gz' AS path,
  i.exchange || '_' || i.dataset || '_' || t.trading_day || '_Trades.csv.gz' AS flat
FROM (SELECT DISTINCT instrument_id, trading_day FROM fx_trades) t JOIN fx_instruments i ON i.instrument_id = t.instrument_id""")
def cache_locations(fx: Fixtures) -> DataFrame:
    """Locations built for every instrument-day with trades, and taken apart again."""
    days = coverage.present_days(fx.trades(), TRADES.name).join(fx.instruments(), "instrument_id")
    slug = venues.exchange_slug(F.col("exchange"))
    day, kind, dataset = F.col("trading_day"), F.col("instrument_type"), F.col("dataset")
    tag = locations.feed_tag(F.col("feed"))
    path = F.concat(F.lit("cache/"), locations.cache_location(slug, kind, dataset, F.col("base_asset"), day, tag))
    flat = locations.flat_location(F.col("exchange"), dataset, day, F.col("feed"))
    built = days.select(path.alias("path"), flat.alias("flat"))
    return built.withColumns(locations.parse_cache_location(F.col("path"), "cache"))


@query(f"""SELECT DISTINCT upper(i.dataset) AS dataset, t.trading_day AS file_day FROM fx_trades t
JOIN fx_instruments i ON i.instrument_id = t.instrument_id WHERE i.instrument_type <> 'spot'""")
def import_skip_report(fx: Fixtures) -> DataFrame:
    """Cached instrument-days left out when only spot data sets are known."""
    listing = (
        coverage.present_days(fx.trades(), TRADES.name)
        .join(fx.instruments().select("instrument_id", "dataset"), "instrument_id")
        .select("dataset", F.col("trading_day").alias("file_day"))
    )
    names = facts.dataset_map(fx.instruments(), instrument_type="spot")
    return raw_files.skipped_files(listing, names)


@query("""SELECT trading_day, count(*) AS done, count(*) FILTER (event_type NOT IN ('click', 'error')) AS saved,
  count(*) FILTER (event_type = 'click') AS missing, count(*) FILTER (event_type = 'error') AS failed
FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS trading_day, event_type FROM events) GROUP BY ROLLUP (trading_day)""")
def outcome_summary(fx: Fixtures) -> DataFrame:
    kind = F.col("event_type")
    results = fx.table("events").select(
        F.to_date("ts").alias("trading_day"),
        F.when(~kind.isin("click", "error"), F.col("event_id").cast("string")).alias("path"),
        F.when(kind == "click", "404").when(kind == "error", "timed out").alias("error"),
    )
    return manifest.outcome_summary(results)


@query()
def storage_report(fx: Fixtures) -> DataFrame:
    """Files and bytes of the given tables; sizes are no SQL matter, a test holds them against the listed files."""
    tables = {name: f"{fx.folder}/{name}.parquet" for name in ("events", "lineitem", "customer", "orders")}
    return maintenance.storage_report(fx.spark, tables)


# ---- paging, rollups, retention ---------------------------------------------------------------------------------------
@query("""SELECT * FROM fx_trades ORDER BY trade_id LIMIT 50 OFFSET 100""")
def page_trades(fx: Fixtures) -> DataFrame:
    return raw_files.page(fx.trades(), 50, 100, "trade_id")


@query("""SELECT symbol, timestamp, local_timestamp, price, amount, side, is_snapshot FROM raw_levels
ORDER BY timestamp, local_timestamp, price, amount, symbol, side, is_snapshot LIMIT 50 OFFSET 20""")
def page_level_updates(fx: Fixtures) -> DataFrame:
    order = ["timestamp", "local_timestamp", "price", "amount", "symbol", "side", "is_snapshot"]
    return raw_files.page(fx.raw_levels().select(*order), 50, 20, *order)


@query("""SELECT *, row_number() OVER (ORDER BY trade_id) - 1 AS position FROM fx_trades
QUALIFY position >= count(*) OVER () // 2 AND position < count(*) OVER () // 2 + 50""")
def page_trades_by_position(fx: Fixtures) -> DataFrame:
    """Fifty trades from the middle of all trades, found by the positions of slices."""
    pages = pages_ops.index_pages(fx.trades(), new_folder(fx.spark, "pages"), "trade_id", slices=16)
    return pages.page(50, len(pages) // 2)


@query("""SELECT symbol, timestamp, local_timestamp, price, amount, side, is_snapshot,
  row_number() OVER (ORDER BY timestamp, local_timestamp, price, amount, symbol, side, is_snapshot) - 1 AS position FROM raw_levels
QUALIFY position >= count(*) OVER () - 30""")
def page_level_updates_by_position(fx: Fixtures) -> DataFrame:
    """The last level updates, by a page that reaches beyond the end."""
    order = ["timestamp", "local_timestamp", "price", "amount", "symbol", "side", "is_snapshot"]
    pages = pages_ops.index_pages(fx.raw_levels().select(*order), new_folder(fx.spark, "pages"), *order, slices=16)
    return pages.page(1000, len(pages) - 30)


@query("""SELECT date_trunc('hour', ts) AS bucket, instrument_id, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value
FROM fx_trades GROUP BY 1, 2""")
def hourly_rollup(fx: Fixtures) -> DataFrame:
    rows = fx.trades().withColumn("price", F.col("price").cast("decimal(18,2)"))
    return maintenance.rollup_avg(rows, "instrument_id", "price")


@query("""SELECT date_trunc('hour', ts) AS bucket, instrument_id, CAST(sum(CAST(CASE WHEN date_trunc('hour', ts) >= TIMESTAMP '2024-01-18 13:00:00'
  AND date_trunc('hour', ts) < TIMESTAMP '2024-01-25 11:00:00' THEN price ELSE quantity END AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value
FROM fx_trades GROUP BY 1, 2""")
def refresh_rollup(fx: Fixtures) -> DataFrame:
    """Hours of the refresh window are averaged anew (over price); the others keep what they held (averages of quantity)."""
    cents = "decimal(18,2)"
    rows = fx.trades().withColumns({"price": F.col("price").cast(cents), "quantity": F.col("quantity").cast(cents)})
    held = maintenance.rollup_avg(rows, "instrument_id", "quantity")
    now = dt.datetime(2024, 1, 25, 12, 40)
    return maintenance.refresh_rollup(held, rows, now, "instrument_id", "price")


@query("""SELECT date_trunc('hour', ts) AS bucket, instrument_id, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value
FROM fx_trades GROUP BY 1, 2""")
def continuous_rollup(fx: Fixtures) -> DataFrame:
    """The hourly rollup kept by a stream over the trades' table."""
    base = new_folder(fx.spark, "rollup")
    as_stored(fx.trades()).withColumn("price", F.col("price").cast("decimal(18,2)")).write.parquet(f"{base}/trades")
    schema = fx.spark.read.parquet(f"{base}/trades").schema
    stream = fx.spark.readStream.schema(schema).parquet(f"{base}/trades")
    hourly = rollup.hourly_stream(stream, "instrument_id", "price")
    rollup.write_rollup(hourly, f"{base}/rollup", f"{base}/checkpoint", "instrument_id", once=True).awaitTermination()
    rows = rollup.read_rollup(fx.spark, f"{base}/rollup")
    return rows.withColumn("instrument_id", F.col("instrument_id").cast("bigint"))


@query("""SELECT date_trunc('hour', ts) AS bucket, instrument_id, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value
FROM fx_trades GROUP BY 1, 2""")
def rollup_begun_anew(fx: Fixtures) -> DataFrame:
    """The rollup after a second stream, with a memory of its own, took the last day's files again and final days were folded."""
    base = new_folder(fx.spark, "rollup")
    rows = as_stored(fx.trades()).withColumn("price", F.col("price").cast("decimal(18,2)")).withColumn("d", F.col("trading_day"))
    rows.repartition("d").write.partitionBy("d").parquet(f"{base}/trades")
    schema = rows.drop("d").schema
    last = child_names(fx.spark, f"{base}/trades")[-1]
    for k, source in enumerate((f"{base}/trades", f"{base}/trades/{last}")):
        stream = fx.spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        hourly = rollup.hourly_stream(stream, "instrument_id", "price")
        rollup.write_rollup(hourly, f"{base}/rollup", f"{base}/checkpoint{k}", "instrument_id", once=True).awaitTermination()
        rollup.fold_rollup(fx.spark, f"{base}/rollup", "instrument_id")
    rows = rollup.read_rollup(fx.spark, f"{base}/rollup")
    return rows.withColumn("instrument_id", F.col("instrument_id").cast("bigint"))


@query(f"""SELECT date_trunc('hour', ts) AS bucket, CAST(instrument_id AS VARCHAR) AS instrument_id,
  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value FROM fx_trades
WHERE {VALID} AND ((ts >= TIMESTAMP '2024-01-03 13:00:00' AND ts < TIMESTAMP '2024-01-10 11:00:00')
  OR (ts >= TIMESTAMP '2024-01-09 01:00:00' AND ts < TIMESTAMP '2024-01-15 23:00:00')) GROUP BY ALL""")
def kept_rollup(fx: Fixtures) -> DataFrame:
    """The lake's hourly rollup after two refreshes whose windows overlap, with a compaction of the trades between them."""
    lake = _lake(fx)
    lake.refresh_rollup(TRADES.name, dt.datetime(2024, 1, 10, 12, 40))
    lake.compact(TRADES.name, "2024-01-31")
    lake.refresh_rollup(TRADES.name, dt.datetime(2024, 1, 16, 0, 30))
    return lake.rollup(TRADES.name)


@query("""SELECT CAST(instrument_id AS VARCHAR) AS instrument_id, dataset, CAST(current_date - 1 AS VARCHAR) AS trading_day FROM fx_instruments""")
def requested_without_day(fx: Fixtures) -> DataFrame:
    """Requests that name no day mean yesterday."""
    names = fx.instruments().withColumn("instrument_id", F.col("instrument_id").cast("string"))
    return load.requested_instruments(names.select("instrument_id"), names).select("instrument_id", "dataset", "trading_day")


@query("SELECT * FROM fx_trades WHERE trading_day >= '2024-01-16'")
def retention_kept(fx: Fixtures) -> DataFrame:
    return maintenance.retained(fx.trades(), as_of="2024-04-15")


@query("SELECT DISTINCT trading_day FROM fx_trades WHERE trading_day < '2024-01-16'")
def retention_expired(fx: Fixtures) -> DataFrame:
    return maintenance.expired_days(fx.trades(), as_of="2024-04-15")


@query("SELECT * FROM fx_trades WHERE trading_day >= '2024-01-16' AND price > 0 AND quantity >= 0")
def retention_dropped(fx: Fixtures) -> DataFrame:
    """A loaded table after its expired day folders were dropped."""
    path = new_folder(fx.spark, "retention")
    load.append_trades(as_stored(fx.trades()), path, on_invalid="reject", buckets=BUCKETS)
    maintenance.drop_expired_days(fx.spark, path, as_of="2024-04-15")
    return _stored(fx, TRADES, path)
