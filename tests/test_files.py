import datetime as dt
import os

import pytest
from conftest import LEVELS_HEADER, MIDNIGHT, TRADES_HEADER
from pyspark.sql import functions as F

from tapelake.operators import normalize
from tapelake.plans import importing, load, refresh
from tapelake.schemas import LEVELS, TRADES
from tapelake.sources import facts, raw_files

DAY = dt.date(2024, 1, 15)


def test_read_trades(spark, folder, trades_file):
    path = trades_file(f"{folder}/btcusdt_2024-01-15_trades.csv.gz")
    raw = raw_files.read_trades(spark, path)
    assert raw.count() == 7
    rows = normalize.normalize_trades(raw.withColumn("instrument_id", F.lit("i1"))).orderBy("ts", "trade_id").collect()
    assert [(r.trade_id, r.side) for r in rows] == [(1, 1), (2, -1), (2, -1), (4, 0), (5, 0), (6, 0)]
    assert str(rows[0].quantity) == "1E-18" and str(rows[1].quantity) == "1.00E-7" or float(rows[1].quantity) == 1e-7
    assert {r.trading_day for r in rows} == {DAY}
    assert [r.id for r in normalize.without_raw_time(raw).collect()] == [3]


def test_script_coding_keeps_null_sides(spark, folder, trades_file):
    raw = raw_files.read_trades(spark, trades_file(f"{folder}/x_2024-01-15_trades.csv.gz"))
    rows = normalize.normalize_trades(raw.withColumn("instrument_id", F.lit("i1")), "script").orderBy("ts", "trade_id")
    assert [r.side for r in rows.collect()] == [1, 2, 2, 1, None, None]


def test_level_sequences(spark, folder, levels_file):
    raw = raw_files.read_level_updates(spark, levels_file(f"{folder}/btcusdt_2024-01-15_l2.csv.gz"))
    by_time = normalize.sequence_sorted(raw, ["_file"]).orderBy("update_seq").collect()
    assert [(r.update_seq, int(r.price)) for r in by_time] == [(1, 0), (2, 41998), (3, 41999), (4, 42001)]
    arrival = normalize.sequence_arrival(raw, ["_file"]).orderBy("update_seq").collect()
    assert [(r.update_seq, int(r.price)) for r in arrival] == [(0, 41999), (1, 42001), (2, 0), (3, 41998)]


def test_arrival_order_over_many_files(spark, folder, write_csv):
    for name in range(5):
        lines = [f"x,S{name},{MIDNIGHT},{MIDNIGHT},false,bid,{(i * 7919) % 500},{i}" for i in range(500)]
        write_csv(f"{folder}/s{name}_2024-01-15_l2.csv.gz", LEVELS_HEADER, *lines)
    raw = raw_files.read_level_updates(spark, folder)
    numbered = normalize.sequence_arrival(raw, ["_file"], group_rows=100)
    assert numbered.count() == 2500
    assert numbered.filter(F.col("update_seq") != F.col("amount")).count() == 0


def test_absent_and_empty_files(spark, folder, write_csv):
    assert raw_files.read_trades(spark, f"{folder}/nothing.csv.gz").count() == 0
    path = write_csv(f"{folder}/empty_2024-01-15_trades.csv.gz", TRADES_HEADER)
    empty = raw_files.read_trades(spark, path)
    assert empty.count() == 0 and empty.columns[:8] == TRADES.raw.names


def test_malformed_value_and_header_fail(spark, folder, write_csv):
    bad = write_csv(f"{folder}/a/x_2024-01-15_trades.csv.gz", TRADES_HEADER, "e,s,abc,1,1,buy,1,1")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        raw_files.read_trades(spark, bad).collect()
    swapped = write_csv(
        f"{folder}/b/x_2024-01-15_trades.csv.gz", "exchange,symbol,local_timestamp,timestamp,id,side,price,amount", "e,s,1,2,1,buy,1,1"
    )
    with pytest.raises(Exception, match="CSV header"):
        raw_files.read_trades(spark, swapped).collect()


def catalog_of(spark, folder, write_json, *elements):
    path = write_json(f"{folder}/list/BinanceFutures.json", list(elements))
    raw = raw_files.read_instruments(spark, path, "BinanceFutures")
    refresh.refresh_instruments(spark, raw, "BinanceFutures", f"{folder}/instruments")
    return facts.read_catalog(spark, f"{folder}/instruments")


def test_scan_and_list_cache(spark, folder, trades_file, levels_file):
    base = f"{folder}/cache/binance-futures/perpetual"
    trades_file(f"{base}/BTCUSDT/btcusdt_2024-01-15_trades.csv.gz")
    trades_file(f"{base}/nested/ethusdt/ethusdt_2024-01-16_trades.csv.gz")
    trades_file(f"{base}/BTCUSDT/btcusdt_2024-02-15_trades.csv.gz")
    levels_file(f"{base}/BTCUSDT/btcusdt_2024-01-15_l2.csv.gz")
    open(f"{base}/BTCUSDT/btcusdt_2024-01-17_l2.csv.gz", "wb").close()
    rows = raw_files.scan_cache(
        spark, f"{folder}/cache", "binance-futures", "perpetual", TRADES, start="2024-01-15", end="2024-01-20"
    )
    found = {(r.dataset, r.file_day) for r in rows.select("dataset", "file_day").distinct().collect()}
    assert found == {("BTCUSDT", DAY), ("ETHUSDT", dt.date(2024, 1, 16))}
    listing = raw_files.list_cache(spark, f"{folder}/cache")
    assert listing.count() == raw_files.filled_files(listing).count() == 4
    assert {r.slug for r in listing.collect()} == {"binance-futures"}
    none = raw_files.scan_cache(spark, f"{folder}/cache", "okex", "spot", TRADES, date="2024-01-15")
    assert none.count() == 0


def test_import_cache(spark, folder, trades_file, levels_file, write_json, instrument_json):
    base = f"{folder}/cache/binance-futures/perpetual"
    trades_file(f"{base}/btcusdt/btcusdt_2024-01-15_trades.csv.gz")
    levels_file(f"{base}/btcusdt/btcusdt_2024-01-15_l2.csv.gz")
    trades_file(f"{base}/UNKNOWN/unknown_2024-01-15_trades.csv.gz", "UNKNOWN")
    names = catalog_of(spark, folder, write_json, instrument_json())
    tables = {"Trades": f"{folder}/trades", "LevelUpdates": f"{folder}/levels"}

    def run(**options):
        return importing.import_cache(
            spark, f"{folder}/cache", names, "BinanceFutures", "perpetual", tables, date=DAY, buckets=1, **options
        )

    first = run()
    assert (first["Trades"].received, first["Trades"].inserted, first["Trades"].skipped) == (6, 5, 1)
    assert first["LevelUpdates"].inserted == 4
    again = run()
    assert again["Trades"].inserted == 0 and again["LevelUpdates"].inserted == 0
    with pytest.raises(load.LoadRejected):
        run(strict=True)
    skipped = importing.import_skips(spark, f"{folder}/cache", names, "BinanceFutures", "perpetual").collect()
    assert [r.dataset for r in skipped] == ["UNKNOWN"]
    stored = facts.read_feed(spark, LEVELS, f"{folder}/levels").orderBy("update_seq").collect()
    assert [(r.update_seq, r.side, r.is_snapshot) for r in stored] == [
        (1, -1, False),
        (2, 0, False),
        (3, 1, True),
        (4, -1, True),
    ]


def test_script_import_fails_on_unknown_side(spark, folder, trades_file, write_json, instrument_json):
    trades_file(f"{folder}/cache/binance-futures/perpetual/BTCUSDT/b_2024-01-15_trades.csv.gz")
    names = catalog_of(spark, folder, write_json, instrument_json())
    tables = {"Trades": f"{folder}/trades", "LevelUpdates": f"{folder}/levels"}
    with pytest.raises(load.LoadRejected, match="null side"):
        importing.import_cache(
            spark, f"{folder}/cache", names, "BinanceFutures", "perpetual", tables, date=DAY, side_coding="script"
        )
    assert not os.path.exists(f"{folder}/trades")


def test_instrument_list(spark, folder, write_json, instrument_json):
    path = write_json(
        f"{folder}/list.json",
        [
            instrument_json(),
            None,
            instrument_json(datasetId="ETHUSDT", baseCurrency="eth", type="swap", listing=None),
            instrument_json(datasetId="X", type="option"),
            instrument_json(datasetId="", baseCurrency="ada"),
            instrument_json(datasetId="SOLUSDT", baseCurrency="sol", priceIncrement=None),
            instrument_json(datasetId="USDTUSDT", baseCurrency="usdt", active=None),
        ],
    )
    raw = raw_files.read_instruments(spark, path, "BinanceFutures")
    assert raw.count() == 6 and {r.exchange for r in raw.collect()} == {"BinanceFutures"}
    table = f"{folder}/instruments"
    with pytest.raises(refresh.RefreshRejected):
        refresh.refresh_instruments(spark, raw, "BinanceFutures", table, on_invalid="fail")
    assert not os.path.exists(table)
    assert refresh.refresh_instruments(spark, raw, "BinanceFutures", table) == {"inserted": 3, "rejected": 1}
    rows = {r.dataset: r for r in facts.read_catalog(spark, table).collect()}
    assert set(rows) == {"BTCUSDT", "ETHUSDT", "USDTUSDT"}
    assert rows["BTCUSDT"].listing == dt.datetime(2024, 1, 1) and rows["USDTUSDT"].active
    assert [r.reason for r in refresh.refresh_rejects(raw).collect()] == ["price increment"]


def test_refresh_overwrites_with_nulls_and_keeps_ids(spark, folder, write_json, instrument_json):
    names = catalog_of(spark, folder, write_json, instrument_json(), instrument_json(datasetId="E", baseCurrency="eth"))
    before = {r.dataset: r.instrument_id for r in names.collect()}
    path = write_json(f"{folder}/next.json", [instrument_json(margin=None, listing=None, datasetId="BTC2")])
    raw = raw_files.read_instruments(spark, path, "BinanceFutures")
    table = f"{folder}/instruments"
    assert refresh.refresh_instruments(spark, raw, "BinanceFutures", table) == {"updated": 1, "kept": 1}
    rows = {r.dataset: r for r in facts.read_catalog(spark, table).collect()}
    assert rows["BTC2"].instrument_id == before["BTCUSDT"] and rows["E"].instrument_id == before["E"]
    assert rows["BTC2"].margin is None and rows["BTC2"].listing is None
    other = write_json(f"{folder}/okex.json", [instrument_json()])
    raw = raw_files.read_instruments(spark, other, "OkexSwap")
    assert refresh.refresh_instruments(spark, raw, "OkexSwap", table) == {"inserted": 1}
    assert facts.read_catalog(spark, table).count() == 3
    empty = raw_files.read_instruments(spark, write_json(f"{folder}/none.json", []), "OkexSwap")
    assert refresh.refresh_instruments(spark, empty, "OkexSwap", table) == {"kept": 1}
    assert facts.read_catalog(spark, table).count() == 3


def test_feed_list():
    assert raw_files.feed_list(["L2", "trades", "l2"]) == ["l2", "trades"]
    for bad in ([], ["orders"]):
        with pytest.raises(ValueError):
            raw_files.feed_list(bad)
