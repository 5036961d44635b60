"""The SQL twins of the queries, for DuckDB over the same tables.

Rules shared with ``queries.present``: days and open flags as text, decimals as double, integers as bigint, timestamps without zone.
"""

from __future__ import annotations

INSTRUMENTS = """fx_instruments AS (
SELECT c.c_custkey AS instrument_id,
  md5(concat_ws('|', 'A' || CAST(c.c_custkey AS VARCHAR), c.c_mktsegment, x.exchange)) AS symbol_id,
  'A' || CAST(c.c_custkey AS VARCHAR) AS base_asset, c.c_mktsegment AS quote_asset, x.exchange,
  CASE c.c_custkey % 3 WHEN 0 THEN 'spot' WHEN 1 THEN 'perpetual' ELSE 'future' END AS instrument_type,
  upper('A' || CAST(c.c_custkey AS VARCHAR) || c.c_mktsegment) AS dataset,
  c.c_acctbal > 0 AS active,
  CASE WHEN c.c_custkey % 10 <> 0 THEN CAST(DATE '2024-01-01' + CAST(c.c_custkey % 30 AS INT) AS TIMESTAMP) END AS available_since,
  CAST(c.c_custkey % 5 AS DOUBLE) AS price_increment,
  CAST(c.c_nationkey % 4 AS DOUBLE) AS amount_increment,
  CAST(1 AS DOUBLE) AS min_trade_amount,
  CAST(c.c_nationkey - 2 AS DOUBLE) AS maker_fee,
  CAST(x.n_regionkey AS DOUBLE) AS taker_fee,
  CAST(c.c_custkey % 2 = 0 AS VARCHAR) AS margin,
  CAST(NULL AS VARCHAR) AS inverse,
  CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS contract_multiplier,
  CASE WHEN c.c_custkey % 10 <> 0 THEN CAST(DATE '2024-01-01' + CAST(c.c_custkey % 30 AS INT) AS TIMESTAMP) END AS listing,
  CASE WHEN c.c_custkey % 4 = 0 THEN CAST(DATE '2024-01-15' + CAST(c.c_custkey % 60 AS INT) AS TIMESTAMP) END AS expiration
FROM customer c JOIN (
  SELECT n_nationkey, n_regionkey, CASE n_regionkey WHEN 0 THEN 'BinanceSpot' WHEN 1 THEN 'BinanceFutures'
    WHEN 2 THEN 'OkexFutures' WHEN 3 THEN 'KucoinSpot' ELSE 'KucoinFutures' END AS exchange FROM nation) x
  ON x.n_nationkey = c.c_nationkey)"""

TRADES = """fx_trades AS (
SELECT e.ts, e.user_id AS instrument_id,
  CAST(CASE e.event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN -1 ELSE 0 END AS BIGINT) AS side,
  CAST(CAST(e.value AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS quantity,
  e.event_id AS trade_id, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS trading_day
FROM events e)"""

LEVELS = """fx_levels AS (
SELECT l_shipdate AS ts, l_suppkey AS instrument_id,
  CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS BIGINT) AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
  l_linestatus = 'F' AS is_snapshot, CAST(l_linenumber AS BIGINT) AS update_seq,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trading_day
FROM lineitem)"""

RAW_TRADES = """raw_trades AS (
SELECT lower(i.exchange) AS exchange, lower(i.dataset) AS symbol, e.ts,
  CASE WHEN CAST(json_extract_string(e.props, '$.k') AS INT) <> 0 THEN epoch_us(e.ts) END AS timestamp,
  epoch_us(e.ts) AS local_timestamp, e.event_id AS id,
  CASE e.event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' WHEN 'view' THEN 'BUY' WHEN 'error' THEN 'unknown' END AS side,
  CAST(CAST(e.value AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS amount,
  i.instrument_id, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS file_day, i.dataset, i.exchange AS venue
FROM events e JOIN fx_instruments i ON i.instrument_id = e.user_id)"""

RAW_LEVELS = """raw_levels AS (
SELECT 'L' || CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts, epoch_us(l_shipdate) AS timestamp,
  epoch_us(l_shipdate) + l_orderkey AS local_timestamp, l_linestatus = 'F' AS is_snapshot,
  CASE l_returnflag WHEN 'R' THEN 'bid' WHEN 'A' THEN 'ask' ELSE 'BID' END AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  l_suppkey AS instrument_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS file_day
FROM lineitem)"""

REFRESH = """fx_refresh AS (
SELECT CASE WHEN o.o_orderstatus = 'P' THEN 'N' ELSE 'A' END || CAST(o.o_custkey AS VARCHAR) AS base_asset,
  i.quote_asset, i.exchange, i.instrument_type, i.dataset, o.o_orderstatus <> 'F' AS active,
  o.o_orderdate AS available_since, CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price_increment,
  CAST(1 AS DOUBLE) AS amount_increment, CAST(2 AS DOUBLE) AS min_trade_amount,
  CAST(0 AS DOUBLE) AS maker_fee, CAST(0 AS DOUBLE) AS taker_fee,
  CASE WHEN o.o_orderpriority <> '1-URGENT' THEN 'true' END AS margin, 'false' AS inverse,
  CASE WHEN o.o_orderpriority <> '1-URGENT' THEN CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS contract_multiplier,
  CASE WHEN o.o_orderpriority <> '1-URGENT' THEN o.o_orderdate END AS listing,
  CAST(NULL AS TIMESTAMP) AS expiration, o.o_orderkey AS ordinal
FROM orders o JOIN fx_instruments i ON i.instrument_id = o.o_custkey)"""

LISTED = """fx_list AS (
SELECT c_custkey AS ordinal,
  CASE WHEN c_custkey % 4 <> 0 THEN 'a' || CAST(c_custkey AS VARCHAR) || lower(c_mktsegment) END AS dataset_own,
  CASE WHEN c_custkey % 7 <> 0 THEN ' Sym' || CAST(c_custkey AS VARCHAR) || ' ' END AS symbol,
  CASE WHEN c_custkey % 11 <> 0 THEN 'a' || CAST(c_custkey AS VARCHAR) END AS base, lower(c_mktsegment) AS quote,
  CASE c_custkey % 5 WHEN 0 THEN 'swap' WHEN 1 THEN 'spot' WHEN 2 THEN 'perp' WHEN 3 THEN 'future' ELSE 'option' END AS kind,
  CASE WHEN c_custkey % 2 = 0 THEN c_acctbal > 0 END AS active,
  CASE c_custkey % 3 WHEN 0 THEN CAST(DATE '2024-01-02' + CAST(c_custkey % 30 AS INT) AS TIMESTAMP) + INTERVAL 90 MINUTE
    WHEN 1 THEN CAST(DATE '2024-01-01' + CAST(c_custkey % 30 AS INT) AS TIMESTAMP) END AS since_ts,
  CASE WHEN c_custkey % 6 = 0 THEN DATE '2024-01-25' END AS to_day,
  CASE WHEN c_custkey % 13 <> 0 THEN 1 ELSE 0 END AS price_increment
FROM customer)"""

LEVEL_FILES = """level_files AS (
SELECT *, epoch_us(CAST(day AS TIMESTAMP)) + (l_orderkey % 86400) * 1000000 AS timestamp,
  row_number() OVER (PARTITION BY dataset, day ORDER BY l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)),
    CAST(l_quantity AS DECIMAL(18,2)), CASE l_returnflag WHEN 'R' THEN 'bid' WHEN 'A' THEN 'ask' ELSE 'BID' END, l_linestatus = 'F') - 1 AS place
FROM (SELECT *, 'LVL' || CAST(l_suppkey % 5 AS VARCHAR) AS dataset, 'i' || CAST(l_suppkey % 5 AS VARCHAR) AS instrument_id,
  CAST(DATE '2024-01-01' + CAST((CAST(l_shipdate AS DATE) - DATE '1992-01-01') % 28 AS INT) AS DATE) AS day FROM lineitem)
WHERE NOT (dataset = 'LVL3' AND day(day) % 2 = 0))"""

MONTH_LEVELS = """fx_month AS (
SELECT make_timestamp(epoch_us(CAST(day AS TIMESTAMP)) + (l_orderkey % 86400) * 1000000) AS ts, instrument_id,
  CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS BIGINT) AS side,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
  l_linestatus = 'F' AS is_snapshot, CAST(l_linenumber AS BIGINT) AS update_seq, CAST(day AS VARCHAR) AS trading_day
FROM (SELECT *, 'i' || CAST(l_suppkey % 5 AS VARCHAR) AS instrument_id,
  CAST(DATE '2024-01-01' + CAST((CAST(l_shipdate AS DATE) - DATE '1992-01-01') % 28 AS INT) AS DATE) AS day FROM lineitem))"""

VIEWS = {
    "fx_month": (MONTH_LEVELS, []),
    "level_files": (LEVEL_FILES, []),
    "fx_instruments": (INSTRUMENTS, []),
    "fx_trades": (TRADES, []),
    "fx_levels": (LEVELS, []),
    "raw_trades": (RAW_TRADES, ["fx_instruments"]),
    "raw_levels": (RAW_LEVELS, []),
    "fx_refresh": (REFRESH, ["fx_instruments"]),
    "fx_list": (LISTED, []),
}


def sql(body: str) -> str:
    """Put the views that ``body`` names in front of it."""
    used: list[str] = []
    for name, (text, needs) in VIEWS.items():
        if name in body:
            for view in (*needs, name):
                if view not in used:
                    used.append(view)
    body = body.strip()
    views = ",\n".join(VIEWS[v][0] for v in used)
    if body.startswith("WITH "):
        return f"WITH {views},\n{body[5:]}" if views else body
    return f"WITH {views}\n{body}" if views else body
