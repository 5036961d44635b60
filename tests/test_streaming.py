import datetime as dt
import pathlib

import pytest
from conftest import MIDNIGHT
from pyspark.sql import functions as F

from tapelake.schemas import LEVELS, TRADES
from tapelake.sources import facts
from tapelake.streaming import ingest, rollup, unique


def names(spark):
    return spark.createDataFrame([("BTCUSDT", "i1")], "dataset string, instrument_id string")


def test_ingest_picks_up_new_files_once(spark, folder, trades_file):
    def run():
        ingest.ingest_new_files(
            spark, TRADES, f"{folder}/in", names(spark), f"{folder}/t", f"{folder}/cp", "*_trades.csv.gz", buckets=1
        ).awaitTermination()
        return facts.read_feed(spark, TRADES, f"{folder}/t").count()

    trades_file(f"{folder}/in/a/btcusdt_2024-01-15_trades.csv.gz")
    trades_file(f"{folder}/in/a/other_2024-01-15_trades.csv.gz", "OTHER")
    assert run() == 5
    assert run() == 5
    trades_file(f"{folder}/in/b/btcusdt_2024-01-15_trades.csv.gz")  # the same rows in another file
    trades_file(f"{folder}/in/b/btcusdt_2024-01-16_trades.csv.gz", day=MIDNIGHT + 86_400_000_000)
    assert run() == 10


def test_replayed_batches_insert_nothing(spark, folder, trades_file):
    trades_file(f"{folder}/in/btcusdt_2024-01-15_trades.csv.gz")
    for checkpoint in ("one", "two"):
        ingest.ingest_new_files(
            spark, TRADES, f"{folder}/in", names(spark), f"{folder}/t", f"{folder}/{checkpoint}", buckets=1
        ).awaitTermination()
    assert facts.read_feed(spark, TRADES, f"{folder}/t").count() == 5


def test_ingest_levels_in_arrival_order(spark, folder, levels_file):
    levels_file(f"{folder}/in/btcusdt_2024-01-15_l2.csv.gz")
    ingest.ingest_new_files(
        spark, LEVELS, f"{folder}/in", names(spark), f"{folder}/l", f"{folder}/cp", sequence="arrival", buckets=1
    ).awaitTermination()
    rows = facts.read_feed(spark, LEVELS, f"{folder}/l").orderBy("update_seq").collect()
    assert [(r.update_seq, int(r.price)) for r in rows] == [(0, 41999), (1, 42001), (2, 0), (3, 41998)]


def event(hour, minute, host, value, day=1):
    return (dt.datetime(2024, 1, day, hour, minute), host, value)


def test_continuous_rollup(spark, folder):
    schema = "ts timestamp, host string, v decimal(18,2)"

    def feed(*rows):
        frame = spark.createDataFrame(rows, "ts timestamp, host string, v double")
        frame.withColumn("v", F.col("v").cast("decimal(18,2)")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        hourly = rollup.hourly_stream(stream, "host", "v")
        rollup.write_rollup(hourly, f"{folder}/out", f"{folder}/cp", "host", once=True).awaitTermination()
        latest = rollup.read_rollup(spark, f"{folder}/out")
        assert latest.count() == latest.select("bucket", "host").distinct().count()
        return {(r.bucket.day, r.bucket.hour, r.host): r.avg_value for r in latest.collect()}

    assert feed(event(1, 0, "a", 1.0), event(1, 30, "a", 2.0), event(2, 0, "b", 5.0)) == {
        (1, 1, "a"): 1.5,
        (1, 2, "b"): 5.0,
    }
    # A late row changes its hour; the other hour stays.
    assert feed(event(1, 59, "a", 6.0)) == {(1, 1, "a"): 3.0, (1, 2, "b"): 5.0}
    later = feed(event(0, 0, "a", 1.0, day=20))
    assert later[(20, 0, "a")] == 1.0
    # More than 7 days behind the stream: too late.
    assert feed(event(1, 5, "a", 100.0)) == later


def hours(spark, path):
    return {(r.bucket.day, r.bucket.hour, r.host): r.avg_value for r in rollup.read_rollup(spark, path).collect()}


def rollup_source(spark, folder, parts):
    """A file for each list of rows, in folders by day of the first row."""
    for rows in parts:
        frame = spark.createDataFrame(rows, "ts timestamp, host string, v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in/d{rows[0][0].day:02}")


def run_rollup(spark, folder, source, checkpoint):
    stream = spark.readStream.schema("ts timestamp, host string, v decimal(18,2)").option("recursiveFileLookup", "true").parquet(source)
    hourly = rollup.hourly_stream(stream, "host", "v")
    rollup.write_rollup(hourly, f"{folder}/out", checkpoint, "host", once=True).awaitTermination()


def test_rollup_begun_anew_over_part_of_the_source(spark, folder):
    rollup_source(spark, folder, [[event(1, 0, "a", 1.0), event(2, 0, "b", 5.0)], [event(1, 30, "a", 2.0), event(1, 0, None, 4.0)], [event(1, 10, "a", 9.0, day=2)]])
    # Parts of hour 1 stand in the second day's folder too.
    rollup_source(spark, folder, [[event(5, 0, "a", 1.0, day=2), event(1, 50, "a", 6.0)]])
    run_rollup(spark, folder, f"{folder}/in", f"{folder}/one")
    expected = {(1, 1, "a"): 3.0, (1, 2, "b"): 5.0, (1, 1, None): 4.0, (2, 1, "a"): 9.0, (2, 5, "a"): 1.0}
    assert hours(spark, f"{folder}/out") == expected
    run_rollup(spark, folder, f"{folder}/in/d02", f"{folder}/two")
    assert hours(spark, f"{folder}/out") == expected
    run_rollup(spark, folder, f"{folder}/in", f"{folder}/three")
    assert hours(spark, f"{folder}/out") == expected


def test_rollup_batch_cut_short(spark, folder):
    """Some of a batch's files are there already, the newest hour among them, when the batch is repeated."""
    rollup_source(spark, folder, [[event(1, 0, "a", 1.0), event(1, 0, "a", 3.0, day=20)]])
    run_rollup(spark, folder, f"{folder}/in", f"{folder}/one")
    kept = spark.read.parquet(f"{folder}/out").where("day > '2024-01-10'").collect()
    schema = spark.read.parquet(f"{folder}/out").schema
    spark.createDataFrame(kept, schema).write.partitionBy("day").parquet(f"{folder}/again/out")
    run_rollup(spark, f"{folder}/again", f"{folder}/in", f"{folder}/two")
    assert hours(spark, f"{folder}/again/out") == {(1, 1, "a"): 1.0, (20, 1, "a"): 3.0}


def test_fold_rollup(spark, folder):
    rollup_source(spark, folder, [[event(1, n, "a", float(n)), event(2, n, "b", 1.0)] for n in range(4)])
    for k in range(2):  # repeated partial sums are folded once
        run_rollup(spark, folder, f"{folder}/in", f"{folder}/cp{k}")
    assert rollup.fold_rollup(spark, f"{folder}/out", "host") == 0
    rollup_source(spark, folder, [[event(0, 0, "a", 7.0, day=9)]])
    run_rollup(spark, folder, f"{folder}/in", f"{folder}/cp0")
    expected = {(1, 1, "a"): 1.5, (1, 2, "b"): 1.0, (9, 0, "a"): 7.0}
    assert hours(spark, f"{folder}/out") == expected
    assert rollup.fold_rollup(spark, f"{folder}/out", "host") == 2
    assert hours(spark, f"{folder}/out") == expected
    assert rollup.fold_rollup(spark, f"{folder}/out", "host") == 0
    # A stream begun anew finds the folded hours final.
    run_rollup(spark, folder, f"{folder}/in", f"{folder}/cp9")
    assert hours(spark, f"{folder}/out") == expected


def test_unique_stream(spark, folder):
    rows = [(dt.datetime(2024, 1, 1, 0, n % 5), "i1", n % 5) for n in range(20)]
    spark.createDataFrame(rows, "ts timestamp, instrument_id string, trade_id long").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("ts timestamp, instrument_id string, trade_id long").parquet(f"{folder}/in")
    query = (
        unique.unique_stream(stream, TRADES.key)
        .writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 5


NOW = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
IDS = "ts timestamp, instrument_id string, trade_id long"


def trade(trade_id, **ago):
    return (NOW - dt.timedelta(**ago), "i1", trade_id)


def deliver(spark, folder, *rows):
    spark.createDataFrame(rows, IDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run_unique(spark, folder, checkpoint="cp", **options):
    stream = spark.readStream.schema(IDS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    options = {"lead": dt.timedelta(minutes=1), "delay": dt.timedelta(hours=6), **options}
    unique.write_unique(stream, TRADES.key, f"{folder}/out", f"{folder}/{checkpoint}", once=True, **options).awaitTermination()
    return sorted(r.trade_id for r in unique.read_unique(spark, f"{folder}/out").collect())


def test_unique_table_keeps_late_rows(spark, folder):
    deliver(spark, folder, trade(1, minutes=1), trade(1, minutes=1), trade(2, hours=3))
    deliver(spark, folder, trade(1, minutes=1), trade(3, days=2))  # a new row two days late
    deliver(spark, folder, trade(3, days=2), trade(4, days=2), trade(5, days=9))
    deliver(spark, folder, trade(5, days=9), trade(2, hours=3), (None, "i1", 6), (None, "i1", 6))
    assert run_unique(spark, folder) == [1, 2, 3, 4, 5, 6]
    # State that forgets at once: the table alone tells copies.
    deliver(spark, folder, trade(4, days=2), trade(7, days=2), (None, "i1", 6))
    assert run_unique(spark, folder) == [1, 2, 3, 4, 5, 6, 7]
    assert run_unique(spark, folder, "another") == [1, 2, 3, 4, 5, 6, 7]


def test_unique_table_without_state(spark, folder):
    """Each batch by a new checkpoint: no state tells copies."""
    for k, rows in enumerate([[trade(1, days=3), trade(2, days=1)], [trade(1, days=3), trade(3, days=3)], [trade(2, days=1)]]):
        deliver(spark, folder, *rows)
        got = run_unique(spark, folder, f"cp{k}")
    assert got == [1, 2, 3]


def test_unique_batch_replayed(spark, folder):
    """A batch whose rows were added before it was committed is taken again."""
    soon = [(NOW + dt.timedelta(minutes=30), "i1", n) for n in range(3)]
    deliver(spark, folder, *soon)
    assert run_unique(spark, folder) == [0, 1, 2]
    deliver(spark, folder, (soon[0][0], "i1", 3), *soon)
    assert run_unique(spark, folder) == [0, 1, 2, 3]
    # The commit after the last batch's rows is taken away with all that followed, so that Spark repeats it.
    last = int(next(pathlib.Path(f"{folder}/out/{unique.NOTES}").glob("*/last")).read_text())
    for log, first in (("commits", last), ("offsets", last + 1)):
        for file in pathlib.Path(f"{folder}/cp/{log}").iterdir():
            if int(file.name.strip(".").removesuffix(".crc")) >= first:
                file.unlink()
    assert run_unique(spark, folder) == [0, 1, 2, 3]
    assert (pathlib.Path(f"{folder}/cp/commits") / str(last)).exists()


def test_unique_table_needs_the_time_among_keys(spark, folder):
    with pytest.raises(ValueError):
        unique.write_unique(spark.readStream.format("rate").load(), ["value"], f"{folder}/out", f"{folder}/cp")
