"""Landing by content: what is the same isn't written, what broke off isn't read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapelake.plans import landing
from tapelake.plans.staging import file_lengths
from tapelake.schemas import TRADES

DAY = dt.date(2024, 1, 15)
RAW = "exchange string, symbol string, timestamp bigint, local_timestamp bigint, id bigint, side string, price decimal(38,18), amount decimal(38,18)"


def rows_of(spark, *rows, file="f", start=0):
    """Rows (dataset, day, id, side) in the order of their lines."""
    lines = [
        (None, d.lower(), 1, 2, i, side, None, None, d, day, f"{file}-{d}-{day}", start + n) for n, (d, day, i, side) in enumerate(rows)
    ]
    raw = spark.createDataFrame(lines, f"{RAW}, dataset string, file_day date, _file string, _arrival bigint")
    return landing.landed_rows(raw, TRADES, F.lit("V"), F.col("file_day"))


def held(spark, path, **days):
    rows = landing.read_landed(spark, TRADES, path, **days).collect()
    return sorted(((r.dataset, r.trading_day, r.id, r.side) for r in rows), key=str)


A = [("A", DAY, 1, "buy"), ("A", DAY, 2, None), ("A", DAY, 2, None)]
B = [("B", DAY, 7, "sell")]


def by_place(rows):
    return sorted(((d, day, i, side) for d, day, i, side in rows), key=str)


def test_same_content_is_not_written(spark, folder):
    path = f"{folder}/landed"
    assert landing.land_raw(rows_of(spark, *A, *B), path) == landing.Landing(2, 0)
    files = file_lengths(spark, path)
    assert landing.land_raw(rows_of(spark, *A, *B), path) == landing.Landing(0, 2)
    # The batch begins to count elsewhere, and the file has another name: neither is content.
    assert landing.land_raw(rows_of(spark, *A, file="g", start=1 << 40), path) == landing.Landing(0, 1)
    assert file_lengths(spark, path) == files
    assert held(spark, path) == by_place(A + B)


@pytest.mark.parametrize(
    "other",
    [
        A[:2],  # a copy less
        [A[1], A[0], A[2]],  # other order
        [("A", DAY, 1, "buy"), ("A", DAY, 2, "buy"), ("A", DAY, 2, None)],  # a null became a value
    ],
)
def test_other_content_replaces_its_data_set_only(spark, folder, other):
    path = f"{folder}/landed"
    landing.land_raw(rows_of(spark, *A, *B), path)
    files = file_lengths(spark, path)
    assert landing.land_raw(rows_of(spark, *other), path) == landing.Landing(1, 0)
    assert files.items() <= file_lengths(spark, path).items()  # neighbours aren't rewritten
    assert held(spark, path) == by_place(other + B)
    # Going back to what was there before is a change too.
    assert landing.land_raw(rows_of(spark, *A), path) == landing.Landing(1, 0)
    assert held(spark, path) == by_place(A + B)


def test_broken_landing_is_not_read(spark, folder, monkeypatch):
    path = f"{folder}/landed"
    landing.land_raw(rows_of(spark, *A), path)

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "write_text", die)
        with pytest.raises(RuntimeError):
            landing.land_raw(rows_of(spark, *A[:1], *B), path)
    assert held(spark, path) == by_place(A)
    assert landing.land_raw(rows_of(spark, *A[:1], *B), path) == landing.Landing(2, 0)
    assert held(spark, path) == by_place(A[:1] + B)


def test_fold(spark, folder):
    path = f"{folder}/landed"
    next_day = [("A", DAY + dt.timedelta(days=1), 9, "buy")]
    landing.land_raw(rows_of(spark, *A, *B, *next_day), path)
    landing.land_raw(rows_of(spark, *A[:1]), path)
    landing.write_rows(rows_of(spark, *B), path, "broken")
    other_day = {name for name in file_lengths(spark, path) if "2024-01-16" in name}
    assert landing.fold_landed(spark, TRADES, path) == 4  # three of A, and one of the landing that broke off
    assert held(spark, path) == by_place(A[:1] + B + next_day)
    assert other_day <= set(file_lengths(spark, path))
    assert landing.fold_landed(spark, TRADES, path) == 0
    assert landing.land_raw(rows_of(spark, *A[:1], *B), path) == landing.Landing(0, 2)
    assert spark.read.parquet(path).count() == 3


def test_fold_that_broke_off(spark, folder, monkeypatch):
    path = f"{folder}/landed"
    landing.land_raw(rows_of(spark, *A, *B), path)
    landing.land_raw(rows_of(spark, *A[:1]), path)
    with monkeypatch.context() as patch:
        patch.setattr(landing.replacement, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            landing.fold_landed(spark, TRADES, path)
    assert held(spark, path) == by_place(A[:1] + B)
    landing.fold_landed(spark, TRADES, path)
    assert held(spark, path) == by_place(A[:1] + B)
    assert spark.read.parquet(path).count() == 2


def test_nothing_and_nameless(spark, folder):
    path = f"{folder}/landed"
    assert landing.land_raw(rows_of(spark, *A).limit(0), path) == landing.Landing(0, 0)
    assert held(spark, path) == []
    with pytest.raises(ValueError, match="data set"):
        landing.land_raw(rows_of(spark, *A).withColumn("dataset", F.lit(None).cast("string")), path)


def test_reading_a_range_lists_its_days_only(spark, folder):
    path = f"{folder}/landed"
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    landing.land_raw(rows_of(spark, *[("A", day, 1, "buy") for day in days]), path)
    rows = landing.read_landed(spark, TRADES, path, days[1], days[1])
    assert [r.trading_day for r in rows.collect()] == [days[1]]
    assert {file.split("trading_day=")[1][:10] for file in rows.inputFiles() if "trading_day=" in file} == {str(days[1])}
