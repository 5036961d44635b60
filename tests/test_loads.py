import datetime as dt
import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapelake.operators import dedup, layout, sequence, validate
from tapelake.plans import load
from tapelake.schemas import LEVELS, LEVELS_FACT, TRADES, TRADES_FACT
from tapelake.session import configure
from tapelake.sources import facts

DAY = dt.date(2024, 1, 15)


def trade(number, second=0, day=DAY, instrument="i1", price="10", quantity="1", side=1):
    ts = f"{day} 00:{second // 60:02d}:{second % 60:02d}"
    return (ts, instrument, side, price, quantity, number, day)


def trades(spark, *rows):
    text = spark.createDataFrame(
        rows, "ts string, instrument_id string, side int, price string, quantity string, trade_id bigint, trading_day date"
    )
    kinds = {f.name: f.dataType for f in TRADES_FACT if f.name != "instr_bucket"}
    return text.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])


def level(seq, second=0, instrument="i1", price="10", quantity="1", snapshot=False):
    return (f"{DAY} 00:{second // 60:02d}:{second % 60:02d}", instrument, 1, price, quantity, snapshot, seq, DAY)


def levels(spark, *rows):
    text = spark.createDataFrame(
        rows,
        "ts string, instrument_id string, side int, price string, quantity string, is_snapshot boolean, update_seq int, "
        "trading_day date",
    )
    kinds = {f.name: f.dataType for f in LEVELS_FACT if f.name != "instr_bucket"}
    return text.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])


def stored(spark, path, spec=TRADES):
    return facts.read_feed(spark, spec, path)


def test_reload_inserts_nothing(spark, folder):
    batch = trades(spark, *[trade(n, n) for n in range(50)], trade(7, 7), trade(7, 8))
    first = load.append_trades(batch, f"{folder}/t", buckets=2)
    assert (first.received, first.inserted, first.skipped, first.rejected) == (52, 51, 1, 0)
    again = load.append_trades(batch, f"{folder}/t", buckets=2)
    assert (again.inserted, again.skipped) == (0, 52)
    assert stored(spark, f"{folder}/t").count() == 51
    assert dedup.repeated_keys(stored(spark, f"{folder}/t"), TRADES.key).count() == 0


def test_stored_rows_win(spark, folder):
    load.append_trades(trades(spark, trade(1, price="10")), f"{folder}/t", buckets=1)
    load.append_trades(trades(spark, trade(1, price="99"), trade(2, price="99")), f"{folder}/t", buckets=1)
    assert {(r.trade_id, int(r.price)) for r in stored(spark, f"{folder}/t").collect()} == {(1, 10), (2, 99)}


def test_order_of_disjoint_loads_does_not_matter(spark, folder):
    a = trades(spark, *[trade(n, n) for n in range(10)])
    b = trades(spark, *[trade(n, n) for n in range(5, 20)])
    for name, batches in (("ab", (a, b)), ("ba", (b, a))):
        for batch in batches:
            load.append_trades(batch, f"{folder}/{name}", buckets=1)
    assert stored(spark, f"{folder}/ab").exceptAll(stored(spark, f"{folder}/ba")).count() == 0


def test_duplicates_in_batch_are_reproducible(spark, folder):
    rows = [trade(1, price=p) for p in ("30", "10", "20")]
    for n in range(3):
        random.Random(n).shuffle(rows)
        load.append_trades(trades(spark, *rows), f"{folder}/{n}", buckets=1)
        assert [int(r.price) for r in stored(spark, f"{folder}/{n}").collect()] == [10]


def test_merge_by_day_keeps_the_earliest(spark, folder):
    load.merge_trades_by_day(trades(spark, trade(1, 30), trade(1, 10), trade(2, 5)), f"{folder}/t", buckets=1)
    report = load.merge_trades_by_day(trades(spark, trade(1, 1), trade(3, 1)), f"{folder}/t", buckets=1)
    assert report.inserted == 1
    assert {(r.trade_id, r.ts.second) for r in stored(spark, f"{folder}/t").collect()} == {(1, 10), (2, 5), (3, 1)}
    batch = levels(spark, level(1, 9), level(1, 3), level(2, 4))
    assert load.merge_level_updates_by_day(batch, f"{folder}/l", buckets=1).inserted == 2


def test_invalid_batch_is_rejected_as_a_whole(spark, folder):
    good = trades(spark, trade(1))
    load.append_trades(good, f"{folder}/t", buckets=1)
    bad = trades(spark, trade(2), trade(3, price="0"), trade(4, quantity="-1"), (None, "i1", 1, "1", "1", 5, None))
    with pytest.raises(load.LoadRejected, match="3 of 4"):
        load.append_trades(bad, f"{folder}/t", buckets=1)
    assert stored(spark, f"{folder}/t").count() == 1
    report = load.append_trades(bad, f"{folder}/t", buckets=1, on_invalid="reject")
    assert report.inserted + report.skipped + report.rejected == report.received == 4
    assert report.reasons == {"price out of range": 1, "quantity out of range": 1, "null ts": 1}
    assert {r.trade_id for r in report.rejects.collect()} == {3, 4, 5}


def test_unknown_instrument(spark, folder):
    names = spark.createDataFrame([("i1",)], "instrument_id string")
    batch = trades(spark, trade(1), trade(2, instrument="i2"))
    with pytest.raises(load.LoadRejected, match="unknown instrument"):
        load.append_trades(batch, f"{folder}/t", catalog=names, buckets=1)
    report = load.append_trades(batch, f"{folder}/t", catalog=names, buckets=1, on_invalid="reject")
    assert (report.inserted, report.reasons) == (1, {"unknown instrument": 1})


def test_zero_price_only_for_levels(spark):
    assert validate.rejected(validate.check_domain(trades(spark, trade(1, price="0")), TRADES)).count() == 1
    assert validate.rejected(validate.check_domain(levels(spark, level(1, price="0")), LEVELS)).count() == 0


def test_strict_append(spark, folder):
    load.append_strict(trades(spark, trade(1), trade(2, 2)), TRADES, f"{folder}/t", buckets=1)
    for rows in ([trade(3, 3), trade(3, 3)], [trade(2, 2), trade(4, 4)]):
        with pytest.raises(load.LoadRejected):
            load.append_strict(trades(spark, *rows), TRADES, f"{folder}/t", buckets=1)
    assert stored(spark, f"{folder}/t").count() == 2


def test_continued_levels(spark, folder):
    load.append_level_updates(levels(spark, *[level(n, n) for n in range(4)]), f"{folder}/l", buckets=1)
    more = levels(spark, *[level(n, 30 + n) for n in range(3)], level(0, 1, instrument="i2"))
    shifted = load.continued_levels(spark, more, f"{folder}/l")
    load.append_level_updates(shifted, f"{folder}/l", buckets=1)
    rows = stored(spark, f"{folder}/l", LEVELS)
    assert sorted(r.update_seq for r in rows.filter("instrument_id = 'i1'").collect()) == list(range(7))
    assert [r.update_seq for r in rows.filter("instrument_id = 'i2'").collect()] == [0]


def test_layout_is_sorted_and_prunes(spark, folder):
    rows = [
        trade(n, (n * 37) % 600, day=DAY + dt.timedelta(days=n % 3), instrument=f"i{n % 5}") for n in range(600)
    ]
    load.append_trades(trades(spark, *rows), f"{folder}/t", buckets=4)
    files = glob.glob(f"{folder}/t/trading_day=*/**/*.parquet", recursive=True)
    assert len({os.path.dirname(f) for f in files}) > 3
    for file in files:
        table = pq.ParquetFile(file).read(columns=["instrument_id", "ts"]).to_pylist()
        keys = [(r["instrument_id"], r["ts"]) for r in table]
        assert keys == sorted(keys)
    scan = facts.scan_feed(spark, TRADES, f"{folder}/t", DAY, instruments=["i0"], buckets=4)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "trading_day" in partition_filters and "instr_bucket" in partition_filters
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(ts" in plan
    assert scan.count() == len([r for r in rows if r[1] == "i0" and r[6] == DAY])


def test_hot_partition_is_split_at_the_write(spark, folder):
    """One (day, bucket) holds everything: it is written by several tasks."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr("id", "uuid() as noise")
        batch = rows.select(
            F.timestamp_micros(F.lit(1_705_276_800_000_000) + F.col("id")).alias("ts"),
            F.lit("hot").alias("instrument_id"),
            F.lit(1).cast("smallint").alias("side"),
            F.abs(F.xxhash64("noise") % 1000 + 2000).cast("decimal(38,18)").alias("price"),
            F.lit(1).cast("decimal(38,18)").alias("quantity"),
            F.col("id").alias("trade_id"),
            F.lit(DAY).alias("trading_day"),
        )
        report = load.append_trades(batch, f"{folder}/t", buckets=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert report.inserted == 60_000
    assert len(glob.glob(f"{folder}/t/trading_day=*/**/*.parquet", recursive=True)) > 1


def test_keep_first_limits_groups_before_the_shuffle(spark):
    plan = dedup.first_per_key(trades(spark, trade(1)), TRADES.key, TRADES.rest)._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert shuffle < partial


def test_new_rows_shuffles_the_batch_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(1000).selectExpr("id as instrument_id", "id as ts", "id as trade_id", "id as side", "id as price")
        new = dedup.new_rows(batch, batch.filter("ts > 5"), TRADES.key, ["side", "price"])
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 6
    finally:
        configure(spark)
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 2  # one for the batch, one for the target's distinct keys


@pytest.mark.parametrize("seed", range(3))
def test_numbering_in_slices_equals_a_plain_window(spark, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(40), rng.randrange(3)) for _ in range(900)]
    rows += [("hot", 7, 1)] * 400  # copies
    rows += [(f"g{n}", rng.randrange(9), 0) for n in range(20) for _ in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(rows, "g string, a int, b int").repartition(5)
    plain = sequence.number_rows(df, ["g"], ["a", "b"], start=0)
    sliced = sequence.number_rows(df, ["g"], ["a", "b"], start=0, group_rows=50)
    want = []
    for group in {r[0] for r in rows}:
        want += [(*row, n) for n, row in enumerate(sorted(r for r in rows if r[0] == group))]
    assert sorted(map(tuple, plain.collect())) == sorted(want)
    assert sorted(map(tuple, sliced.collect())) == sorted(want)


def test_numbering_expands_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sequence, "COPY_BLOCK", 16)
    df = spark.createDataFrame([("g", 1)] * 100 + [("g", 0)] * 3 + [("g", 2)] * 16, "g string, a int")
    numbered = sequence.number_rows(df, ["g"], ["a"], group_rows=10).orderBy("update_seq").collect()
    assert [r.update_seq for r in numbered] == list(range(1, 120))
    assert [r.a for r in numbered] == [0] * 3 + [1] * 100 + [2] * 16


@pytest.mark.parametrize("how", ["fail", "reject", "strict"])
def test_rejected_first_load_leaves_nothing(spark, folder, how):
    path = f"{folder}/t"
    if how == "reject":
        assert load.append_trades(trades(spark, trade(1, price="-1")), path, on_invalid="reject", buckets=3).inserted == 0
    else:
        with pytest.raises(load.LoadRejected):
            if how == "strict":
                load.append_strict(trades(spark, trade(1), trade(1)), TRADES, path, buckets=3)
            else:
                load.append_trades(trades(spark, trade(1), trade(2, price="-1")), path, buckets=3)
    assert not os.path.exists(path)
    assert load.append_trades(trades(spark, trade(1)), path, buckets=5).inserted == 1
    with pytest.raises(ValueError, match="has 5 buckets, not 3"):
        load.append_trades(trades(spark, trade(2)), path, buckets=3)


def test_note_without_rows_counts_for_nothing(spark, folder):
    """A driver that is lost between the note and the rows of a first load."""
    layout.settle_buckets(spark, f"{folder}/t", 3)
    assert load.append_trades(trades(spark, trade(1)), f"{folder}/t", buckets=5).inserted == 1
    assert layout.stored_buckets(spark, f"{folder}/t") == 5


def test_buckets(spark):
    row = spark.range(1).select(layout.instrument_bucket(F.lit("abc"), 64).alias("b")).first()
    assert 0 <= row.b < 64


def test_hot_instrument_is_split_in_a_shuffled_join(spark):
    """Requests too large to broadcast: the hot data set's rows are spread over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 100))
        raw = spark.range(0, 80_000, 1, 8).select(
            hot.alias("dataset"), F.lit(DAY).alias("file_day"), F.md5(F.col("id").cast("string")).alias("price")
        )
        wanted = raw.select("dataset").distinct().select(
            "dataset", F.lit(DAY).alias("trading_day"), F.col("dataset").alias("instrument_id"), F.lit("OkexSpot").alias("exchange")
        )
        joined = load.for_requests(raw, wanted)
        assert joined.count() == 80_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        configure(spark)
    assert "skew=true" in plan or "isSkew=true" in plan or "AQEShuffleRead skewed" in plan


def test_requests_by_day_are_not_broadcast(spark):
    """Spark takes requests that a small table becomes, a row per day, for as small as that table."""
    configure(spark)
    catalog = spark.range(50).select(
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("instrument_id"),
        F.concat(F.lit("A"), F.col("id").cast("string")).alias("base_asset"),
        F.lit("USDT").alias("quote_asset"), F.lit("OkexSpot").alias("exchange"), F.lit("spot").alias("instrument_type"), F.lit("d").alias("dataset"),
    )
    days = F.explode(F.sequence(F.lit(DAY), F.lit(DAY + dt.timedelta(days=30))))
    requests = catalog.select("base_asset", "quote_asset", "exchange", "instrument_type", days.alias("trading_day"))
    wanted = load.requested_instruments(requests.unionByName(requests), catalog)
    assert "Broadcast" not in wanted._jdf.queryExecution().executedPlan().toString()
    assert wanted.count() == 50 * 31


def test_rows_are_dealt_out_before_they_multiply(spark):
    few = spark.range(100).coalesce(1)
    tasks = layout.spread(few, "id").select("id", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("n"), F.spark_partition_id().alias("task"))
    counts = {row.task: row["count"] for row in tasks.groupBy("task").count().collect()}
    assert sum(counts.values()) == 1000 and len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_without_gaps_are_numbered_without_a_shuffle(spark):
    whole = [("a", n) for n in range(40, 60)] + [("b", 7)]
    gaps = [("c", n) for n in (3, 4, 9)] + [("d", n) for n in (0, 5)]
    for rows, shuffled in ((whole, False), (whole + gaps, True), (gaps, True), ([], False)):
        df = spark.createDataFrame(rows[::-1], "source string, place bigint")
        got = sequence.number_consecutive(df, ["source"], "place", start=0)
        want = sequence.number_rows(df, ["source"], ["place"], start=0)
        assert got.schema["update_seq"].dataType == want.schema["update_seq"].dataType
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert ("Window" in plan(got)) == shuffled


def requested(spark):
    """Requests of two days for two instruments of one data set and one of another, the catalog, and raw rows, some without a time."""
    catalog = spark.createDataFrame(
        [("i1", "A", "OkexSpot", "d"), ("i2", "B", "OkexSpot", "d"), ("i3", "C", "OkexSpot", "e")],
        "instrument_id string, base_asset string, exchange string, dataset string",
    ).withColumns({"quote_asset": F.lit("USDT"), "instrument_type": F.lit("spot")})
    days = F.explode(F.sequence(F.lit(DAY), F.lit(DAY + dt.timedelta(days=1))))
    start = int(dt.datetime(DAY.year, DAY.month, DAY.day, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    rows = [(name, day, place, None if (place, name) == (3, "D") else start + day * 86_400_000_000 + place % 4) for name in "DEF" for day in (0, 1, 2) for place in range(10)]
    raw = spark.createDataFrame(rows, "dataset string, day int, _arrival bigint, timestamp bigint").select(
        "*", F.date_add(F.lit(DAY), F.col("day")).alias("file_day"), F.concat("dataset", F.col("day").cast("string")).alias("_file"),
        F.lit(False).alias("is_snapshot"), F.lit("bid").alias("side"), F.lit(1).cast("decimal(38,18)").alias("price"), F.col("_arrival").cast("decimal(38,18)").alias("amount"),
    )
    return catalog.select("instrument_id", days.alias("trading_day")), catalog, raw


def test_few_requests_shuffle_no_raw_row(spark, monkeypatch):
    configure(spark)
    requests, catalog, raw = requested(spark)
    few = load.requested_rows(requests, catalog, raw)
    assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" not in plan(few)
    monkeypatch.setattr(load, "FEW_REQUESTED", 1)
    many = load.requested_rows(requests, catalog, raw)
    assert few.columns == many.columns and few.count() == 60
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


@pytest.mark.parametrize("ids", [["i1", "i3"], ["i1", "i2", "i3"]])
def test_levels_are_numbered_alike_by_either_way(spark, folder, ids):
    """Also where a row lacks its time, or two instruments share a data set, so that a line occurs twice."""
    requests, catalog, raw = requested(spark)
    requests = requests.filter(F.col("instrument_id").isin(ids))
    for unique in (False, True):
        load.load_level_updates(requests, catalog, raw, f"{folder}/{unique}", source=["_file"], unique=unique)
    one, other = (stored(spark, f"{folder}/{unique}", LEVELS) for unique in (False, True))
    columns = ["trading_day", "update_seq", "price", "side"] + (["instrument_id", "quantity"] if len(ids) == 2 else [])
    assert sorted(map(str, one.select(*columns).collect())) == sorted(map(str, other.select(*columns).collect())) and one.count() == len(ids) * 20 - 2 * (len(ids) - 1)
