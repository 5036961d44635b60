import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from test_loads import DAY, trade, trades

from tapelake.operators import catalog, layout, manifest
from tapelake.plans import load, maintenance, replacement, staging
from tapelake.schemas import INSTRUMENT, TRADES
from tapelake.sources import facts


def test_compact_cold(spark, folder):
    path = f"{folder}/t"
    days = [DAY + dt.timedelta(days=n) for n in (0, 1, 20)]
    for part in range(4):
        rows = [trade(10 * part + n, n, day=day, instrument=f"i{n}") for n in range(3) for day in days]
        layout.write_layout(trades(spark, *rows), path, buckets=2)
    before = facts.read_feed(spark, TRADES, path)
    rows, files = sorted(map(tuple, before.collect())), len(glob.glob(f"{path}/**/*.parquet", recursive=True))
    assert maintenance.compact_cold(spark, path, as_of=days[2], buckets=2) == 24
    after = facts.read_feed(spark, TRADES, path)
    assert sorted(map(tuple, after.collect())) == rows
    assert len(glob.glob(f"{path}/**/*.parquet", recursive=True)) < files
    assert maintenance.compact_cold(spark, path, as_of="2000-01-01", buckets=2) == 0
    assert maintenance.compact_cold(spark, path, as_of=days[2], buckets=2) == 0  # compact already
    sizes = maintenance.day_sizes(spark, path).collect()
    assert {r.trading_day for r in sizes} == set(days) and all(r.total_bytes > 0 for r in sizes)


def test_compaction_settles(spark, folder):
    """A bucket well above Spark's advisory size is rewritten once."""
    path = f"{folder}/t"
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(1_705_276_800) + F.col("id") % 80_000).alias("ts"),
        F.lit("i1").alias("instrument_id"), F.lit(1).cast("short").alias("side"), F.rand(1).cast("decimal(38,18)").alias("price"),
        F.rand(2).cast("decimal(38,18)").alias("quantity"), F.col("id").alias("trade_id"), F.lit(DAY).alias("trading_day"),
    )
    spark.conf.set(key, str(64 << 10))
    try:
        layout.write_layout(rows, path, buckets=1)
        counts = [maintenance.compact_cold(spark, path, "2024-03-01", buckets=1, file_bytes=8 << 20) for _ in range(3)]
        assert spark.conf.get(key) == str(64 << 10)
    finally:
        spark.conf.unset(key)
    assert counts == [60_000, 0, 0] and facts.read_feed(spark, TRADES, path).count() == 60_000


def fragmented(spark, path, parts=3, rows=5):
    for part in range(parts):
        layout.write_layout(trades(spark, *[trade(10 * part + n, n) for n in range(rows)]), path, buckets=1)
    return stored(spark, path)


def stored(spark, path):
    return sorted(map(tuple, facts.read_feed(spark, TRADES, path).collect()))


def lost(*_args, **_options):
    raise KeyboardInterrupt


# Where the driver is lost: before the decision, before and while files are moved, while old ones are removed.
@pytest.mark.parametrize("step, calls", [("decide", 0), ("finish", 0), ("move_file", 0), ("remove_file", 0), ("remove_file", 2)])
def test_compaction_is_finished_by_the_next(spark, folder, monkeypatch, step, calls):
    path = f"{folder}/t"
    before = fragmented(spark, path)
    do, left = getattr(replacement, step), [calls]

    def some(*args):
        left[0] -= 1
        return lost() if left[0] < 0 else do(*args)

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(replacement, step, some)
        maintenance.compact_cold(spark, path, "2024-03-01", buckets=1)
    assert stored(spark, path) == before  # each row once, though old and new files may both be there
    more = [trade(100 + n, n) for n in range(11)]
    assert load.append_trades(trades(spark, *more, trade(0, 0)), path, buckets=1).inserted == 11
    after = stored(spark, path)
    assert len(after) == 26 and set(before) < set(after)
    maintenance.compact_cold(spark, path, "2024-03-01", buckets=1)
    assert stored(spark, path) == after
    assert not glob.glob(f"{path}/{replacement.REPLACING}/*")
    assert maintenance.compact_cold(spark, path, "2024-03-01", buckets=1) == 0 and stored(spark, path) == after


def test_load_while_files_are_replaced(spark, folder, monkeypatch):
    path = f"{folder}/t"
    before = fragmented(spark, path)
    finish = replacement.finish

    def meanwhile(session, work):
        load.append_trades(trades(spark, *[trade(200 + n, n) for n in range(4)]), path, buckets=1)
        return finish(session, work)

    monkeypatch.setattr(replacement, "finish", meanwhile)
    assert maintenance.compact_cold(spark, path, "2024-03-01", buckets=1) == 15
    assert len(stored(spark, path)) == 19 and set(before) < set(stored(spark, path))


def test_dropped_days_stay_dropped(spark, folder):
    path = f"{folder}/t"
    fragmented(spark, path)
    layout.write_layout(trades(spark, trade(1, day=DAY + dt.timedelta(days=100))), path, buckets=1)
    maintenance.prepare_compaction(spark, path, maintenance.day_files(spark, path, DAY), buckets=1)
    assert maintenance.drop_expired_days(spark, path, DAY + dt.timedelta(days=100)) == 1
    assert len(stored(spark, path)) == 1
    maintenance.resume_compaction(spark, path)
    assert len(stored(spark, path)) == 1


def test_storage_report(spark, folder):
    """Files and bytes as they are listed; what is hidden beside a table doesn't count."""
    for name, parts in (("one", 1), ("two", 3)):
        fragmented(spark, f"{folder}/{name}", parts)
    load.append_trades(trades(spark, trade(500)), f"{folder}/one", buckets=1)  # keeps a summary
    found = {r.table_name: (r.files, r.total_bytes) for r in maintenance.storage_report(spark, {n: f"{folder}/{n}" for n in ("one", "two")}).collect()}
    for name, files in (("one", 2), ("two", 3)):
        paths = glob.glob(f"{folder}/{name}/trading_day=*/*/*.parquet")
        assert found[name] == (files, sum(map(os.path.getsize, paths))) and len(paths) == files


def test_many_days_a_few_at_a_time(spark, folder, monkeypatch):
    path = f"{folder}/t"
    days = [DAY + dt.timedelta(days=n) for n in range(4)]
    for part in range(2):
        layout.write_layout(trades(spark, *[trade(10 * part + n, n, day=day) for n in range(3) for day in days]), path, buckets=1)
    before = stored(spark, path)
    monkeypatch.setattr(maintenance, "FILES_AT_ONCE", 3)
    assert maintenance.compact_cold(spark, path, "2024-03-01", buckets=1) == 24
    assert stored(spark, path) == before and len(glob.glob(f"{path}/*/*/*.parquet")) == 4


def test_drop_expired_days(spark, folder):
    path = f"{folder}/t"
    layout.write_layout(trades(spark, *[trade(n, day=DAY + dt.timedelta(days=n)) for n in range(5)]), path, buckets=1)
    assert maintenance.drop_expired_days(spark, path, DAY + dt.timedelta(days=93)) == 3
    assert maintenance.stored_days(spark, path) == [DAY + dt.timedelta(days=3), DAY + dt.timedelta(days=4)]
    assert maintenance.drop_expired_days(spark, path, DAY + dt.timedelta(days=93)) == 0


BY_DATASET = ["exchange", "instrument_type", "dataset"]


def named(spark, *rows):
    known = {"base_asset": 0, "dataset": 1, "ordinal": 2}
    frame = spark.createDataFrame(rows, "base_asset string, dataset string, ordinal int")
    fixed = {"quote_asset": "Q", "exchange": "E", "instrument_type": "spot"}
    columns = [F.lit(fixed[f.name]) if f.name in fixed else F.col(f.name) if f.name in known else F.lit(None) for f in INSTRUMENT if not f.name.endswith("_id")]
    names = [f for f in INSTRUMENT if not f.name.endswith("_id")]
    return frame.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, names, strict=True)], "ordinal")


def after(catalog_rows, rows):
    merged = catalog.upsert_instruments(catalog_rows, rows, BY_DATASET).drop("action")
    found = [(r.dataset, r.base_asset, r.instrument_id) for r in merged.collect()]
    assert len({i for *_, i in found}) == len({b for _, b, _ in found}) == len(found)
    return merged, {d: (b, i) for d, b, i in found}


def test_moved_instruments_keep_their_ids(spark):
    nothing = spark.createDataFrame([], INSTRUMENT)
    held, first = after(nothing, named(spark, ("A", "d1", 1), ("B", "d2", 2)))
    held, second = after(held, named(spark, ("C", "d1", 1), ("A", "d3", 2)))  # d1 moves, d3 takes its identity
    assert second["d1"] == ("C", first["d1"][1]) and second["d3"][0] == "A" and second["d3"][1] != first["d1"][1]
    held, third = after(held, named(spark, ("B", "d1", 1), ("C", "d2", 2)))  # an exchange of identities
    assert third["d1"] == ("B", first["d1"][1]) and third["d2"] == ("C", first["d2"][1])


def test_identities_stay_unique(spark):
    held, _ = after(spark.createDataFrame([], INSTRUMENT), named(spark, ("A", "d1", 1), ("B", "d2", 2), ("C", "d3", 3)))
    # d9 claims what d3 holds; d2 wants what d9 would leave free, and so on down the chain; two new ones want one identity.
    rows = named(spark, ("C", "d2", 1), ("B", "d1", 2), ("X", "d7", 3), ("X", "d8", 4))
    refused = {(r.dataset, r.reason) for r in catalog.identity_conflicts(held, rows, BY_DATASET).collect()}
    assert refused == {("d2", "identity is held"), ("d1", "identity is held"), ("d7", "identity comes twice")}
    _, merged = after(held, rows)
    assert {d: b for d, (b, _) in merged.items()} == {"d1": "A", "d2": "B", "d3": "C", "d8": "X"}


def test_latest_of_several_listings(spark):
    """Instruments that share an identity: the latest listing counts, without one last."""
    rows = [("1", None), ("2", dt.datetime(2024, 1, 1)), ("4", dt.datetime(2024, 2, 1)), ("3", dt.datetime(2024, 2, 1))]
    frame = spark.createDataFrame(rows, "instrument_id string, listing timestamp")
    for name in ("base_asset", "quote_asset", "exchange", "instrument_type"):
        frame = frame.withColumn(name, F.lit("x"))
    frame = frame.withColumn("expiration", F.lit(None).cast("timestamp"))
    assert catalog.current_instrument(frame, frame).first().instrument_id == "3"
    assert catalog.current_instrument(frame, frame, "2024-01-15").first().instrument_id == "2"


def test_retention_boundaries(spark):
    days = [DAY + dt.timedelta(days=n) for n in range(3)]
    rows = trades(spark, *[trade(n, day=day) for n, day in enumerate(days)])
    as_of = DAY + dt.timedelta(days=91)
    assert {r.trading_day for r in maintenance.retained(rows, as_of).collect()} == set(days[1:])
    assert [r.trading_day for r in maintenance.expired_days(rows, as_of).collect()] == days[:1]


def test_drop_expired(spark):
    rows = trades(spark, *[trade(n, day=DAY + dt.timedelta(days=n)) for n in range(5)])
    name = "drop_expired_test"
    arranged = layout.arrange(rows, 1)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    arranged.write.partitionBy("trading_day", "instr_bucket").saveAsTable(name)
    try:
        assert maintenance.drop_expired(spark, name, DAY + dt.timedelta(days=93)) == 3
        left = {r.trading_day for r in spark.table(name).collect()}
        assert left == {DAY + dt.timedelta(days=3), DAY + dt.timedelta(days=4)}
        assert maintenance.drop_expired(spark, name, DAY + dt.timedelta(days=93)) == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_refresh_bounds():
    start, end = maintenance.refresh_bounds(dt.datetime(2024, 1, 25, 12, 40))
    assert (start, end) == (dt.datetime(2024, 1, 18, 13), dt.datetime(2024, 1, 25, 11))
    start, end = maintenance.refresh_bounds(dt.datetime(2024, 1, 25, 12))
    assert (start, end) == (dt.datetime(2024, 1, 18, 12), dt.datetime(2024, 1, 25, 11))


@pytest.mark.parametrize(
    "day, available, trading",
    [("2024-01-09", False, False), ("2024-01-10", True, False), ("2024-01-11", True, True), ("2024-01-20", False, False)],
)
def test_availability_boundaries(spark, day, available, trading):
    since, to = F.lit(dt.date(2024, 1, 10)), F.lit(dt.date(2024, 1, 20))
    at = F.lit(dt.date.fromisoformat(day))
    row = spark.range(1).select(
        catalog.available_on(at, since, to).alias("a"),
        catalog.is_trading_date(at, since, to).alias("t"),
        catalog.available_on(at, F.lit(None).cast("date"), F.lit(None).cast("date")).alias("open"),
        catalog.is_trading_date(at, since, F.lit(None).cast("date")).alias("half"),
    )
    assert row.first() == (available, trading, True, False)


def test_manifest_days(spark):
    def listed(since, to):
        day = lambda text: text and dt.date.fromisoformat(text)
        return ("BTC", "btc", "spot", day(since), day(to), "OkexSpot")

    rows = [listed(None, None), listed("2024-01-03", None), listed(None, "2024-01-03"), listed("2025-01-01", None)]
    frame = spark.createDataFrame(
        rows, "dataset string, symbol string, instrument_type string, since date, to date, exchange string"
    )
    got = manifest.download_manifest(frame, F.lit("okex"), ["trades"], start="2024-01-01", end="2024-01-04")
    assert got.count() == 4 + 2 + 2 + 0


def test_outcomes_without_error_or_path(spark):
    rows = [(DAY, "p", None), (DAY, None, None), (DAY, None, "404"), (DAY, "p", "late"), (DAY, None, "500")]
    frame = spark.createDataFrame(rows, "trading_day date, path string, error string")
    total = manifest.outcome_summary(frame).filter("trading_day is null").first()
    assert (total.done, total.saved, total.missing, total.failed) == (5, 1, 1, 3)


def test_has_identity(spark):
    rows = spark.createDataFrame(
        [("BTC", "USDT", "X", "spot"), ("btc", "USDT", "X", "spot")],
        "base_asset string, quote_asset string, exchange string, instrument_type string",
    )
    assert rows.filter(catalog.has_identity("BTC", "USDT", "X", "spot")).count() == 1


def test_rows_from_arrays(spark):
    batch = spark.createDataFrame(
        [(["2024-01-02 00:00:00", "2024-01-01 00:00:00"], ["b", "a"], ["1.5"])],
        "ts array<string>, instrument_id array<string>, price array<string>",
    )
    rows = facts.rows_from_arrays(
        batch, {"ts": "timestamp", "instrument_id": "string", "price": "decimal(38,18)"}
    ).collect()
    assert [(r.instrument_id, r.price and float(r.price)) for r in rows] == [("a", None), ("b", 1.5)]


def test_shared_folder_needs_a_setting_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"
        applicationId = "a"

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, _key, default=None):
            return self.value or default

    class Session:
        sparkContext = Context()

        def __init__(self, value):
            self.conf = Conf(value)

    assert staging.shared_folder(Session("hdfs://x/shared/")) == "hdfs://x/shared"
    with pytest.raises(RuntimeError):
        staging.shared_folder(Session(None))
