"""The hourly rollup kept beside a fact table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapelake.operators.layout import write_layout
from tapelake.plans import maintenance
from tapelake.schemas import PRICE, TRADES

NOW = dt.datetime(2024, 1, 10, 12, 30)


def write(spark, path, *trades):
    rows = spark.createDataFrame(list(trades), "ts timestamp_ntz, price double")
    ts = F.col("ts").cast(TRADES.fact["ts"].dataType)
    columns = {"ts": ts, "instrument_id": F.lit("i"), "price": F.col("price").cast(PRICE), "trading_day": F.to_date(ts)}
    rows = rows.withColumns(columns)
    rest = [f for f in TRADES.fact if f.name not in (*columns, "instr_bucket")]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in rest}).select(*TRADES.columns)
    write_layout(rows, path, 2)


def hours(spark, path):
    rows = maintenance.read_kept_rollup(spark, path).select(F.date_format("bucket", "dd HH").alias("hour"), "avg_value").collect()
    return sorted((r.hour, r.avg_value) for r in rows)


def test_refreshes(spark, folder, monkeypatch):
    facts, path = f"{folder}/facts", f"{folder}/rollup"
    at = lambda day, hour: dt.datetime(2024, 1, day, hour, 5)
    write(spark, facts, (at(3, 12), 1.0), (at(3, 13), 2.0), (at(10, 10), 3.0), (at(10, 10), 5.0), (at(10, 11), 9.0))
    maintenance.keep_rollup(spark, TRADES, facts, path, NOW)
    assert hours(spark, path) == [("03 13", 2.0), ("10 10", 4.0)]  # before the window; after it
    # Late rows: 03 13 is out of the window by then and stays, 10 10 is computed anew.
    write(spark, facts, (at(3, 13), 8.0), (at(10, 10), 10.0))
    later = NOW + dt.timedelta(hours=3)
    with monkeypatch.context() as patch:
        patch.setattr(maintenance.replacement, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            maintenance.keep_rollup(spark, TRADES, facts, path, later)
    want = [("03 13", 2.0), ("10 10", 6.0), ("10 11", 9.0)]
    assert hours(spark, path) == want  # decided, not moved: each hour once
    maintenance.keep_rollup(spark, TRADES, facts, path, later)
    assert hours(spark, path) == want


def test_nothing(spark, folder):
    assert maintenance.keep_rollup(spark, TRADES, f"{folder}/none", f"{folder}/rollup", NOW) == 0
    assert hours(spark, f"{folder}/rollup") == []
