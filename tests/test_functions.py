import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapelake.functions import locations, sides, times, venues


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_micros_to_timestamp(spark):
    row = one(
        spark,
        a=times.micros_to_timestamp(F.lit(1_705_276_800_000_001)).cast("string"),
        n=times.micros_to_timestamp(F.lit(None).cast("bigint")),
    )
    assert row.a == "2024-01-15 00:00:00.000001"
    assert row.n is None
    with pytest.raises(PySparkException):
        one(spark, x=times.micros_to_timestamp(F.lit(9_223_372_036_854_775_807)))


def test_day_boundaries(spark):
    def day(text):
        return times.trading_day(F.lit(text).cast("timestamp"))

    row = one(spark, a=day("2024-01-15 23:59:59.999999"), b=day("2024-01-16 00:00:00"))
    assert row == (dt.date(2024, 1, 15), dt.date(2024, 1, 16))


def test_zone(spark):
    ts = F.lit("2024-01-15 22:30:00.000005").cast("timestamp")
    row = one(spark, d=times.day_in_zone(ts, "Asia/Tokyo"), t=times.time_in_zone(ts, "Asia/Tokyo"))
    assert row == (dt.date(2024, 1, 16), "07:30:00.000005")


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-15T00:00:00.000Z", dt.date(2024, 1, 15)),
        ("2024-01-15T01:00:00+03:00", dt.date(2024, 1, 14)),
        ("2024-01-15T23:30:00", dt.date(2024, 1, 15)),
        ("2024-01-15", dt.date(2024, 1, 15)),
        ("soon", None),
        ("", None),
    ],
)
def test_iso_day(spark, text, day):
    assert one(spark, d=times.iso_day(F.lit(text))).d == day


def test_date_mode():
    day = dt.date(2024, 1, 15)
    assert times.date_mode("2024-01-15") == (day, day)
    assert times.date_mode(start="2024-01-15", end=day) == (day, day)
    for bad in (
        {},
        {"start": "2024-01-15"},
        {"date": "2024-01-15", "end": "2024-01-16"},
        {"start": "2024-01-16", "end": "2024-01-15"},
        {"date": "15.1.2024"},
    ):
        with pytest.raises(ValueError):
            times.date_mode(**bad)


def test_sides(spark):
    texts = ["buy", "sell", "BUY", "unknown", "", None, "bid", "ask"]
    rows = spark.createDataFrame([(t,) for t in texts], "side string")
    got = rows.select(
        sides.trade_side(F.col("side")),
        sides.order_side(F.col("side")),
        sides.script_side(F.col("side"), "trades"),
        sides.script_side(F.col("side"), "l2"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (1, 0, 1, None),
        (-1, 0, 2, None),
        (0, 0, 1, None),
        (0, 0, None, None),
        (0, 0, None, None),
        (0, 0, None, None),
        (0, 1, None, 1),
        (0, -1, None, 2),
    ]


def test_slugs(spark):
    names = ["BinanceSpot", "OkexSpot", "OkexSwap", "OkxSpot", "MoexFutures", "New_Venue"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    styles = ["canonical", "download", "import", "refresh"]
    got = rows.select(*[venues.exchange_slug(F.col("name"), s) for s in styles]).collect()
    assert [tuple(r) for r in got] == [
        ("binance", "binance", "binance-spot", "binance-spot"),
        ("okex", "okexspot", "okx-spot", "okex-spot"),
        ("okex-swap", "okex-swap", "okexswap", "okexswap"),
        ("OkxSpot", "okxspot", "okx-spot", "okxspot"),
        ("MoexFutures", "moexfutures", "moexfutures", "moexfutures"),
        ("New_Venue", "new_venue", "new-venue", "new_venue"),
    ]
    row = one(
        spark,
        a=venues.slug_exchange(F.lit("okex")),
        b=venues.slug_exchange(F.lit("MoexSelt")),
        c=venues.slug_exchange(F.lit("nowhere")),
    )
    assert row == ("OkexSpot", "MoexSelt", None)


def test_exchange_groups(spark):
    code = venues.exchange_code(F.lit("OkexSwap"))
    row = one(
        spark,
        code=code,
        crypto=venues.in_group(code, "Crypto"),
        classic=venues.in_group(code, "Classic"),
        swap=venues.in_group(code, "Swap"),
        moex=venues.in_group(venues.exchange_code(F.lit("MoexSpot")), "Classic"),
        unknown=venues.exchange_code(F.lit("Elsewhere")),
    )
    assert row == (40, True, False, True, True, None)


def test_instrument_type(spark):
    texts = [" Perpetual ", "SWAP", "perp", "future", "option", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(venues.instrument_type(F.col("t")), venues.instrument_type(F.col("t"), True)).collect()
    assert [tuple(r) for r in got] == [
        ("perpetual", "perpetual"),
        (None, "perpetual"),
        (None, "perpetual"),
        ("future", "future"),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_locations(spark):
    day = F.lit(dt.date(2025, 10, 7))
    source = locations.source_location(F.lit("okex"), locations.feed_segment(F.lit("l2")), day, F.lit("BTC-USDT"))
    cache = locations.cache_location(
        F.lit("binance-futures"), F.lit("perpetual"), F.lit("DogeUsdc"), F.lit("DOGEUSDC"), day, F.lit("l2")
    )
    flat = locations.flat_location(F.lit("OkexSpot"), F.lit("BTC"), day, F.lit("LevelUpdates"))
    assert one(spark, s=source, c=cache, f=flat) == (
        "v1/okex/incremental_book_L2/2025/10/07/BTC-USDT.csv.gz",
        "binance-futures/perpetual/DOGEUSDC/dogeusdc_2025-10-07_l2.csv.gz",
        "OkexSpot_BTC_2025-10-07_LevelUpdates.csv.gz",
    )
    with pytest.raises(PySparkException):
        one(spark, x=locations.feed_segment(F.lit("OrdersLog")))


def test_parse_location(spark):
    paths = [
        "file:///cache/binance-futures/perpetual/dogeusdc/dogeusdc_2025-10-17_l2.csv.gz",
        "file:///cache/okex/spot/more/BTC/x_y_2025-10-17_trades.csv.gz",
        "file:///cache/okex/spot/BTC/readme.txt",
    ]
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    parts = locations.parse_cache_location(F.col("path"), "/cache")
    got = rows.select(*[c.alias(n) for n, c in parts.items()]).collect()
    day = dt.date(2025, 10, 17)
    assert [tuple(r) for r in got] == [
        ("binance-futures", "perpetual", "DOGEUSDC", day, "l2"),
        ("okex", "spot", "BTC", day, "trades"),
        ("okex", "spot", None, None, None),
    ]


def test_parts_of_matched_files(spark):
    row = one(
        spark,
        **{f"c_{n}": c for n, c in locations.cached_parts(F.lit("file:/c/okex/spot/btc-usd/x_y_2025-10-07_l2.csv.gz")).items()},
        **{f"d_{n}": c for n, c in locations.delivered_parts(F.lit("s3://b/v1/okex/trades/2025/10/07/Btc.Usd.csv.gz")).items()},
        bad=locations.cached_parts(F.lit("file:/c/BTC/x_2025-13-07_l2.csv.gz"))["file_day"],
    ).asDict()
    day = dt.date(2025, 10, 7)
    assert row == {
        "c_dataset": "BTC-USD",
        "c_file_day": day,
        "d_slug": "okex",
        "d_dataset": "BTC.USD",
        "d_file_day": day,
        "bad": None,
    }
