import datetime as dt
import os
import re

import pytest
from conftest import DAY_MICROS, MIDNIGHT
from pyspark.sql import functions as F

from tapelake.lake import Lake
from tapelake.operators import coverage, layout
from tapelake.plans import landing, load, summaries
from tapelake.schemas import TRADES
from tapelake.sources import facts

DAY = dt.date(2024, 1, 15)


@pytest.fixture
def lake(spark, folder, trades_file, levels_file, write_json, instrument_json):
    source = f"{folder}/source"
    for number in range(2):
        day = DAY + dt.timedelta(days=number)
        where = f"{day:%Y/%m/%d}/BTCUSDT.csv.gz"
        trades_file(f"{source}/v1/binance-futures/trades/{where}", day=MIDNIGHT + number * DAY_MICROS)
        levels_file(f"{source}/v1/binance-futures/incremental_book_L2/{where}", day=MIDNIGHT + number * DAY_MICROS)
    # The same data set name on another exchange.
    trades_file(f"{source}/v1/okex-swap/trades/2024/01/15/BTCUSDT.csv.gz")
    lake = Lake(spark, f"{folder}/lake", source, buckets=2)
    listed = [
        instrument_json(),
        instrument_json(datasetId="ETHUSDT", baseCurrency="eth", expiry="2024-01-20T00:00:00Z"),
        instrument_json(datasetId="OLD", baseCurrency="old", active=False),
    ]
    lake.refresh_instruments(write_json(f"{folder}/lists/futures.json", listed), "BinanceFutures")
    lake.refresh_instruments(write_json(f"{folder}/lists/swap.json", [instrument_json()]), "OkexSwap")
    return lake


def btc(lake, day=DAY, feed=None, exchange="BinanceFutures"):
    return lake.request("BTC", "USDT", exchange, day=day, feed=feed)


def test_instruments(lake, spark):
    assert lake.instrument(btc(lake)).first().dataset == "BTCUSDT"
    assert lake.instrument(lake.request("btc", "USDT", "BinanceFutures")).count() == 0
    eth = lake.request("ETH", "USDT", "BinanceFutures")
    assert lake.instrument(eth, "2024-01-19").count() == 1
    assert lake.instrument(eth, "2024-01-20").count() == 0  # at the expiration
    assert lake.instrument(eth, "2023-12-31").count() == 0
    assert lake.instrument(eth, "2024-01-01").count() == 1  # at the listing
    listed = lake.list_instruments("BinanceFutures", "perpetual", "2024-01-19").collect()
    assert [r.base_asset for r in listed] == ["BTC", "ETH"]
    assert [r.base_asset for r in lake.list_instruments("BinanceFutures", "perpetual").collect()] == ["BTC"]
    one = lake.instrument(eth).select("instrument_id")
    assert lake.instrument_by_id(one).first().base_asset == "ETH"


def test_load_and_ask(lake):
    report = lake.load_trades(btc(lake))
    assert (report.received, report.inserted) == (6, 5)
    assert lake.load_trades(btc(lake)).inserted == 0
    assert lake.load_level_updates(btc(lake)).inserted == 4
    info = lake.info(btc(lake, feed="Trades")).collect()
    assert [(r.items_count, r.first_ts, r.last_ts) for r in info] == [
        (5, dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 23, 59, 59, 999999))
    ]
    assert lake.info(btc(lake, DAY + dt.timedelta(days=1), "Trades")).count() == 0
    requests = btc(lake, feed="Trades").unionByName(btc(lake, feed="LevelUpdates"))
    requests = requests.unionByName(btc(lake, feed="OrdersLog")).unionByName(btc(lake, feed="Trades", exchange="OkexSwap"))
    requests = requests.unionByName(lake.request("NO", "USDT", "BinanceFutures", day=DAY, feed="Trades"))
    has = {(r.base_asset, r.exchange, r.feed): r.has_data for r in lake.exists(requests).collect()}
    assert has == {
        ("BTC", "BinanceFutures", "Trades"): True,
        ("BTC", "BinanceFutures", "LevelUpdates"): True,
        ("BTC", "BinanceFutures", "OrdersLog"): False,
        ("BTC", "OkexSwap", "Trades"): False,
        ("NO", "BinanceFutures", "Trades"): False,
    }
    missing = lake.missing_days(requests.drop("trading_day"), "2024-01-14", "2024-01-16").collect()
    days = {}
    for r in missing:
        days.setdefault((r.base_asset, r.exchange, r.feed), []).append(r.trading_day.day)
    assert days == {
        ("BTC", "BinanceFutures", "Trades"): [14, 16],
        ("BTC", "BinanceFutures", "LevelUpdates"): [14, 16],
        ("BTC", "BinanceFutures", "OrdersLog"): [14, 15, 16],
        ("BTC", "OkexSwap", "Trades"): [14, 15, 16],
        ("NO", "BinanceFutures", "Trades"): [14, 15, 16],
    }
    sizes = {r.table_name: r.files for r in lake.storage_report().collect()}
    assert set(sizes) == {"Trades", "LevelUpdates"}


def test_load_by_id_and_unknown(lake, spark):
    ids = lake.instrument(btc(lake)).select("instrument_id", F.lit(DAY).alias("trading_day"))
    ids = ids.unionByName(spark.createDataFrame([("nobody", DAY)], "instrument_id string, trading_day date"))
    assert lake.load_trades(ids).inserted == 5
    assert load.unknown_requests(ids, lake.catalog).count() == 1
    nothing = lake.load_trades(lake.request("NO", "USDT", "BinanceFutures", day=DAY))
    assert (nothing.received, nothing.inserted) == (0, 0)
    assert lake.load_trades(btc(lake, day="2024-03-01")).inserted == 0  # no such file


def test_letter_case_of_file_names(lake, folder, trades_file):
    """A file is found by its data set whatever the letter case, for any number of requests."""
    day = DAY + dt.timedelta(days=4)
    trades_file(f"{folder}/source/v1/binance-futures/trades/{day:%Y/%m/%d}/btcusdt.csv.gz", day=MIDNIGHT + 4 * DAY_MICROS)
    assert lake.load_trades(btc(lake, day=day)).inserted == 5
    report = lake.load_trades(btc(lake, day=day).unionByName(btc(lake)).unionByName(lake.request("NO", "USDT", "OkexSwap", day=DAY)))
    assert (report.inserted, report.unknown, report.absent.count()) == (5, 1, 0)
    files = lake.source_files(TRADES, load.requested_instruments(btc(lake), lake.catalog))
    assert [r.path.rsplit("/", 1)[1] for r in files.collect()] == ["BTCUSDT.csv.gz"]  # nothing else of the folder


def test_absent_files(lake):
    days = [lake.request("ETH", "USDT", "BinanceFutures", day=day) for day in ("2023-12-31", "2024-01-01", "2024-01-19", "2024-01-20")]
    requests = btc(lake)
    for one in days:
        requests = requests.unionByName(one)
    report = lake.load_trades(requests)
    assert report.inserted == 5 and report.absent_expected == 2
    assert sorted((str(r.trading_day), r.expected) for r in report.absent.collect()) == [
        ("2023-12-31", False), ("2024-01-01", True), ("2024-01-19", True), ("2024-01-20", False)
    ]
    with pytest.raises(load.FilesMissing):
        lake.load_trades(requests, on_absent="fail")


def test_buckets_are_kept_with_the_table(lake, spark):
    lake.load_trades(btc(lake))
    other = Lake(spark, lake.root, lake.source, buckets=64)
    requests = btc(lake, feed="Trades")
    assert other.info(requests).count() == 1 and other.exists(requests).first().has_data
    assert other.missing_days(requests, DAY, DAY).count() == 0
    assert other.load_trades(btc(lake, day="2024-01-16")).inserted == 5  # with the table's own number
    with pytest.raises(ValueError, match="2 buckets"):
        load.append_trades(lake.facts(TRADES), lake.table(TRADES), buckets=64)


def test_maintenance_of_the_lake(lake):
    lake.load_trades(btc(lake).unionByName(btc(lake, day="2024-01-16")))
    assert lake.drop_expired("Trades", DAY + dt.timedelta(days=91)) == 1
    assert [r.trading_day for r in lake.facts(TRADES).select("trading_day").distinct().collect()] == [DAY + dt.timedelta(days=1)]
    assert lake.compact("Trades", "2024-03-01") == 0


def test_several_files(lake):
    both = btc(lake).unionByName(btc(lake, day="2024-01-16"))
    assert lake.load_trades(both).inserted == 10
    assert lake.load_trades(btc(lake, exchange="OkexSwap")).inserted == 5
    assert lake.facts(TRADES).select("instrument_id").distinct().count() == 2


def test_missing_data_set_fails(lake, spark):
    broken = lake.catalog.withColumn("dataset", F.lit(""))
    with pytest.raises(Exception, match="no data set"):
        load.requested_instruments(btc(lake), broken).collect()


def test_pages(lake):
    page = lake.page_trades("BinanceFutures", "BTCUSDT", DAY, count=3, skip=2).collect()
    assert [r.id for r in page] == [2, 3, 4]
    assert lake.page_trades("BinanceFutures", "BTCUSDT", DAY, count=10, skip=6).count() == 1
    assert lake.page_trades("BinanceFutures", "NOTHING", DAY, count=10).count() == 0
    levels = lake.page_level_updates("BinanceFutures", "BTCUSDT", DAY, count=2).collect()
    assert [r.side for r in levels] == ["bid", "ask"]


def test_land(lake, spark):
    for _ in range(2):
        lake.land(btc(lake), "Trades")
    lake.land(btc(lake, exchange="OkexSwap"), "Trades")
    landed = landing.read_landed(spark, TRADES, f"{lake.root}/landed/trades")
    assert {(r.venue, r["count"]) for r in landed.groupBy("venue").count().collect()} == {
        ("BinanceFutures", 7),
        ("OkexSwap", 7),
    }


def test_land_keeps_other_data_sets(lake, spark, folder, trades_file):
    trades_file(f"{folder}/source/v1/binance-futures/trades/2024/01/15/ETHUSDT.csv.gz", "ETHUSDT")
    lake.land(btc(lake), "Trades")
    for _ in range(2):
        lake.land(lake.request("ETH", "USDT", "BinanceFutures", day=DAY), "Trades")
    landed = landing.read_landed(spark, TRADES, f"{lake.root}/landed/trades")
    assert {(r.dataset, r["count"]) for r in landed.groupBy("dataset").count().collect()} == {("BTCUSDT", 7), ("ETHUSDT", 7)}
    lines = landed.filter("dataset = 'ETHUSDT'").orderBy("_file", "_arrival").collect()
    assert [r.id for r in lines] == [1, 2, 2, 3, 4, 5, 6] and all("ETHUSDT" in r._file for r in lines)


def test_land_reads_touched_files_only(lake, spark, trades_file):
    place = f"{lake.source}/v1/binance-futures/trades/2024/01/15/BTCUSDT.csv.gz"
    assert lake.land(btc(lake), "Trades") == landing.Landing(1, 0, 0)
    assert lake.land(btc(lake), "Trades") == landing.Landing(0, 0, 1)
    os.utime(place, (1, 1))  # touched, and the same: read, not written; then known by its new time
    assert lake.land(btc(lake), "Trades") == landing.Landing(0, 1, 0)
    assert lake.land(btc(lake), "Trades") == landing.Landing(0, 0, 1)
    trades_file(place, "BTCUSDT", MIDNIGHT + 1)
    assert lake.land(btc(lake), "Trades") == landing.Landing(1, 0, 0)
    rows = landing.read_landed(spark, TRADES, lake.landed("Trades"))
    assert rows.count() == 7 and rows.agg(F.min("timestamp")).first()[0] == MIDNIGHT + 1
    assert lake.fold_landed("Trades") == 7
    assert landing.read_landed(spark, TRADES, lake.landed("Trades")).count() == 7


def test_one_feed_day(lake):
    lake.load_trades(btc(lake))
    is_btc = (F.col("base_asset") == "BTC") & (F.col("exchange") == "BinanceFutures")
    one = coverage.feed_day_info_one(lake.catalog, lake.feeds(), is_btc, "Trades", DAY)
    assert one.first().items_count == 5
    one = lake.info_one("BTC", "USDT", "BinanceFutures", "perpetual", DAY, "Trades")
    assert one.first().items_count == 5
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"instrument_id#\d+ = ", plan) and "instr_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    for feed, day in (("OrdersLog", DAY), ("Trades", "2024-01-16"), ("LevelUpdates", DAY)):
        assert coverage.feed_day_info_one(lake.catalog, lake.feeds(), is_btc, feed, day).count() == 0


def test_manifest(lake, folder, write_json, instrument_json, trades_file):
    path = write_json(f"{folder}/lists/m.json", [instrument_json(), instrument_json(datasetId="X", type="spot")])
    trades_file(f"{folder}/cache/binance-futures/perpetual/BTCUSDT/btcusdt_2024-01-15_trades.csv.gz")
    rows = lake.manifest(path, "BinanceFutures", "Perpetual", f"{folder}/cache", start="2024-01-15", end="2024-01-16")
    assert sorted(r.cache for r in rows.collect()) == [
        "binance-futures/perpetual/BTCUSDT/btcusdt_2024-01-15_l2.csv.gz",
        "binance-futures/perpetual/BTCUSDT/btcusdt_2024-01-16_l2.csv.gz",
        "binance-futures/perpetual/BTCUSDT/btcusdt_2024-01-16_trades.csv.gz",
    ]


def test_manifest_of_yesterday(lake, folder, write_json, instrument_json):
    path = write_json(f"{folder}/lists/y.json", [instrument_json()])
    yesterday = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    rows = lake.manifest(path, "BinanceFutures", "perpetual", f"{folder}/no-cache", feeds=["trades"]).collect()
    assert [r.trading_day for r in rows] == [yesterday]


def test_coverage_prunes_days_and_never_runs_python(lake):
    lake.load_trades(btc(lake).unionByName(btc(lake, day="2024-01-16")))
    lake.load_level_updates(btc(lake))
    requests = btc(lake, feed="Trades")
    for df in (lake.info(requests), lake.exists(requests), lake.missing_days(requests, "2024-01-15", "2024-01-15")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
        assert "level_updates" not in plan  # a feed nobody asked for is not read
        files = [f for f in df.inputFiles() if "/instruments/" not in f]
        assert files and all("/trades/_summary/trading_day=" in f for f in files)  # no fact file is opened


def test_days_without_summary_are_counted_by_folder(lake):
    """Two requests ten years apart open two folders, those of their instruments."""
    both = btc(lake).unionByName(btc(lake, day="2024-01-16"))
    lake.load_trades(both)
    path, ids = lake.table(TRADES), [f"x{n}" for n in range(20)]
    held = lake.facts(TRADES)
    assert held.count() == 10
    far = held.withColumns({"ts": F.col("ts") - F.expr("INTERVAL 10 YEARS"), "trading_day": F.add_months("trading_day", -120)})
    others = held.crossJoin(lake.spark.createDataFrame([(i,) for i in ids], "other string")).withColumn("instrument_id", F.col("other")).drop("other")
    layout.write_layout(far.unionByName(others), path, lake.buckets_of(TRADES))
    summaries.mark(lake.spark, path, [DAY, dt.date(2024, 1, 16)])
    requests = btc(lake, feed="Trades").unionByName(btc(lake, day="2014-01-16", feed="Trades"))
    info = lake.info(requests)
    rows = {(r.trading_day, r.items_count) for r in info.collect()}
    assert {d for d, _ in rows} == {DAY, dt.date(2014, 1, 16)}
    plan = info._jdf.queryExecution().executedPlan().toString()
    pruned = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("trading_day" in f and "instr_bucket" in f for f in pruned)
    wanted = summaries.in_pairs(coverage.requested_pairs(requests, lake.catalog, lake.buckets_of(TRADES)))
    assert facts.read_feed(lake.spark, TRADES, path).where(wanted).select("trading_day", "instr_bucket").distinct().count() == 2
    assert lake.exists(requests).where("has_data").count() == 2
    mended = lake.mend_summaries()["Trades"]
    assert len(mended) == 4 and {(r.trading_day, r.items_count) for r in lake.info(requests).collect()} == rows


@pytest.mark.parametrize("lost_at", ["write_layout", "refresh"])
def test_broken_loads_leave_no_wrong_summary(lake, monkeypatch, lost_at):
    lake.load_trades(btc(lake))
    before = lake.facts(TRADES).count()

    def lost(*_args, **_options):
        raise KeyboardInterrupt

    rows = lake.facts(TRADES).withColumn("trade_id", F.col("trade_id") + 100)
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(load if lost_at == "write_layout" else summaries, lost_at, lost)
        load.append_trades(rows, lake.table(TRADES), buckets=lake.buckets_of(TRADES))
    info = lake.info(btc(lake, feed="Trades")).first()
    assert info.items_count == lake.facts(TRADES).count() == before * (1 if lost_at == "write_layout" else 2)
    load.append_trades(rows.withColumn("trade_id", F.col("trade_id") + 100), lake.table(TRADES), buckets=lake.buckets_of(TRADES))
    assert summaries.kept_days(lake.spark, lake.table(TRADES)) == {DAY}
    assert lake.info(btc(lake, feed="Trades")).first().items_count == lake.facts(TRADES).count()


def test_requests_with_unknown_instruments(lake):
    lake.load_trades(btc(lake).unionByName(btc(lake, day="2024-01-16")))
    requests = btc(lake, feed="Trades").unionByName(lake.request("NO", "USDT", "OkexSwap", day=DAY, feed="Trades"))
    frames = (lake.info(requests), lake.exists(requests), lake.missing_days(requests, "2024-01-10", "2024-01-20"))
    assert [df.count() for df in frames] == [1, 2, 20]


def test_present_and_missing_make_the_calendar(lake):
    lake.load_trades(btc(lake).unionByName(btc(lake, day="2024-01-16")))
    requests = btc(lake, feed="Trades").drop("trading_day")
    missing = {r.trading_day for r in lake.missing_days(requests, "2024-01-10", "2024-01-20").collect()}
    present = {r.trading_day for r in coverage.present_days(lake.facts(TRADES), "Trades").collect()}
    assert not missing & present and len(missing | present) == 11


def test_missing_days_from_each_request_on(lake):
    lake.load_trades(btc(lake))
    requests = btc(lake, day="2024-01-14", feed="Trades").unionByName(btc(lake, feed="LevelUpdates"))
    missing = lake.missing_days(requests, as_of="2024-01-16").collect()
    assert [(r.feed, r.trading_day.day) for r in missing] == [
        ("LevelUpdates", 15),
        ("LevelUpdates", 16),
        ("Trades", 14),
        ("Trades", 16),
    ]
    assert lake.missing_days(requests, as_of="2024-01-01").count() == 0


def test_no_day_means_yesterday(lake):
    wanted = load.requested_instruments(btc(lake, day=None), lake.catalog).first()
    assert wanted.trading_day == dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


def test_unresolved_default_end(lake):
    today = dt.datetime.now(dt.timezone.utc).date()
    unknown = lake.request("NO", "USDT", "BinanceFutures", feed="Trades").drop("trading_day")
    assert lake.missing_days(unknown, today - dt.timedelta(days=2)).count() >= 3


def test_dataset_map(lake):
    rows = facts.dataset_map(lake.catalog, "BinanceFutures", "perpetual").collect()
    assert {r.dataset for r in rows} == {"BTCUSDT", "ETHUSDT", "OLD"}


def test_requests_are_resolved_without_broadcast(spark):
    """Neither requests by day nor the catalog has the size Spark takes it for; unsupported feeds never meet the summaries."""
    identity = {"base_asset": "A", "quote_asset": "USDT", "exchange": "OkexSpot", "instrument_type": "spot"}
    catalog = spark.range(3).select(F.col("id").cast("string").alias("instrument_id"), *[F.concat(F.lit(v), F.col("id").cast("string")).alias(c) for c, v in identity.items()])
    requests = catalog.drop("instrument_id").select("*", F.explode(F.array(F.lit("Trades"), F.lit("OrdersLog"), F.lit(None))).alias("feed"))
    requests = requests.withColumn("trading_day", coverage.calendar(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 9))))
    resolved = coverage.resolve(requests, catalog)
    assert "Broadcast" not in resolved._jdf.queryExecution().executedPlan().toString()
    assert resolved.count() == 81 and resolved.filter("instrument_id IS NULL").count() == 0
    facts_of = catalog.select("instrument_id", F.lit(dt.date(2024, 1, 5)).alias("trading_day"), F.timestamp_seconds(F.lit(1_704_412_800)).alias("ts"))
    info = coverage.info_of_days(requests, catalog, {"Trades": coverage.feed_days(facts_of, "Trades")})
    assert sorted((r.instrument_id, r.feed, r.items_count) for r in info.collect()) == [(str(i), "Trades", 1) for i in range(3)]
