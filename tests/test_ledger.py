import gzip
import os

import pytest
from conftest import DAY_MICROS, LEVELS_HEADER, MIDNIGHT, TRADES_HEADER

from tapelake.operators import layout
from tapelake.schemas import LEVELS, TRADES
from tapelake.sources import facts
from tapelake.streaming import ingest, ledger


def trade_lines(symbol, *ids, price="10", ts=MIDNIGHT):
    return [f"x,{symbol},{ts + n},{ts + n},{n},buy,{price},1" for n in ids]


@pytest.fixture
def deliver(folder, write_csv):
    def write(name, *lines, header=TRADES_HEADER):
        return write_csv(f"{folder}/in/{name}.csv.gz", header, *lines)

    return write


def names(spark, *known):
    return spark.createDataFrame([(name, f"id-{name}") for name in known], "dataset string, instrument_id string")


def stored(spark, table, spec=TRADES):
    return sorted((r.instrument_id, r[spec.ordinal]) for r in facts.read_feed(spark, spec, table).collect())


def states_of(spark, folder):
    return [(os.path.basename(r.path).split(".")[0], r.dataset, r.state, r.rows, r.invalid, r.reason) for r in ledger.file_states(spark, f"{folder}/t").collect()]


@pytest.mark.parametrize("way", ["stream", "list"])
def test_learned_data_sets(spark, folder, deliver, way):
    """A file with two data sets, of which the catalog learns one after the first pass."""

    def run(*known):
        if way == "list":
            return ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, *known), f"{folder}/t", buckets=1)
        ingest.ingest_new_files(spark, TRADES, f"{folder}/in", names(spark, *known), f"{folder}/t", f"{folder}/cp", buckets=1).awaitTermination()

    deliver("both", *trade_lines("btc", 1, 2), *trade_lines("eth", 3))
    deliver("eth", *trade_lines("eth", 4, 5))
    run("BTC")
    assert stored(spark, f"{folder}/t") == [("id-BTC", 1), ("id-BTC", 2)]
    assert [(os.path.basename(r.path), r.dataset, r.rows) for r in ledger.held_back(spark, f"{folder}/t").orderBy("path").collect()] == [
        ("both.csv.gz", "ETH", 1),
        ("eth.csv.gz", "ETH", 2),
    ]
    run("BTC")
    assert len(stored(spark, f"{folder}/t")) == 2
    deliver("new", *trade_lines("btc", 9))
    run("BTC", "ETH")
    assert stored(spark, f"{folder}/t") == [("id-BTC", 1), ("id-BTC", 2), ("id-BTC", 9), ("id-ETH", 3), ("id-ETH", 4), ("id-ETH", 5)]
    assert ledger.held_back(spark, f"{folder}/t").count() == 0
    notes = ledger.read_ledger(spark, f"{folder}/t").count()
    run("BTC", "ETH")
    assert ledger.read_ledger(spark, f"{folder}/t").count() == notes  # nothing was read again


def test_new_checkpoint_reads_no_settled_file_again(spark, folder, deliver):
    deliver("one", *trade_lines("btc", 1, 2))
    for checkpoint in ("a", "b"):
        ingest.ingest_new_files(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", f"{folder}/{checkpoint}", buckets=1).awaitTermination()
    assert ledger.read_ledger(spark, f"{folder}/t").count() == 1 and len(stored(spark, f"{folder}/t")) == 2


@pytest.mark.parametrize("on_invalid", ["fail", "reject"])
def test_bad_files_do_not_stop_others(spark, folder, deliver, on_invalid):
    deliver("good", *trade_lines("btc", 1))
    deliver("price", *trade_lines("btc", 2), *trade_lines("btc", 3, price="-1"))
    deliver("line", *trade_lines("btc", 4), "x,btc,soon,what,five,buy,1,1")
    deliver("timeless", "x,btc,,1,6,buy,1,1")
    deliver("nothing")
    report = ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", on_invalid=on_invalid, buckets=1)
    loaded = [1] if on_invalid == "fail" else [1, 2, 4]
    assert [n for _, n in stored(spark, f"{folder}/t")] == loaded and report.inserted == len(loaded)
    bad = "rejected" if on_invalid == "fail" else "loaded"
    found = {(name, dataset): (state, rows) for name, dataset, state, rows, *_ in states_of(spark, folder)}
    assert found == {
        ("good", "BTC"): ("loaded", 1),
        ("price", "BTC"): (bad, 2),
        ("line", "BTC"): (bad, 1),
        ("line", None): ("rejected", 1),
        ("timeless", None): ("empty", 1),
        ("nothing", None): ("empty", None),
    }
    assert ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", on_invalid=on_invalid).received == 0


def test_delivered_anew(spark, folder, deliver):
    path = deliver("day", *trade_lines("btc", 1), *trade_lines("btc", 2, price="0"))
    ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", buckets=1)
    assert not os.path.exists(f"{folder}/t/_layout") and [r[2] for r in states_of(spark, folder)] == ["rejected"]
    with gzip.open(path, "wt") as out:
        out.write("\n".join([TRADES_HEADER, *trade_lines("btc", 1, 2, 3)]) + "\n")
    assert ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", buckets=1).inserted == 3
    assert [r[2:4] for r in states_of(spark, folder)] == [("loaded", 3)]


@pytest.mark.parametrize("sequence", ["arrival", "sorted"])
def test_level_numbers_do_not_depend_on_the_pass(spark, folder, deliver, sequence):
    lines = [f"x,{'btc' if n % 2 else 'eth'},{MIDNIGHT + 50 - n},{MIDNIGHT + n},false,bid,{n},1" for n in range(10)]
    deliver("both", *lines, header=LEVELS_HEADER)
    for place, passes in (("one", [("BTC", "ETH")]), ("two", [("ETH",), ("BTC", "ETH")])):
        for known in passes:
            ledger.pick_up(spark, LEVELS, f"{folder}/in", names(spark, *known), f"{folder}/{place}", sequence=sequence, buckets=1)
    assert stored(spark, f"{folder}/one", LEVELS) == stored(spark, f"{folder}/two", LEVELS)
    assert sorted(n for _, n in stored(spark, f"{folder}/one", LEVELS)) == list(range(10) if sequence == "arrival" else range(1, 11))


def test_some_files_at_a_time(spark, folder, deliver, monkeypatch):
    for n in range(5):
        deliver(f"f{n}", *trade_lines("btc", n, ts=MIDNIGHT + n * DAY_MICROS))
    monkeypatch.setattr(ledger, "FILES_AT_ONCE", 2)
    assert ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", buckets=3).inserted == 5
    assert layout.stored_buckets(spark, f"{folder}/t") == 3
    deliver("more", *trade_lines("btc", 9))
    assert ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t").inserted == 1  # keeps its buckets


def test_lost_before_the_note(spark, folder, deliver, monkeypatch):
    deliver("one", *trade_lines("btc", 1, 2))

    def lost(*_args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(ledger, "_note", lost)
        ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", buckets=1)
    assert ledger.pick_up(spark, TRADES, f"{folder}/in", names(spark, "BTC"), f"{folder}/t", buckets=1).inserted == 0
    assert len(stored(spark, f"{folder}/t")) == 2 and [r[2] for r in states_of(spark, folder)] == ["loaded"]


def test_empty_folder(spark, folder):
    assert ledger.pick_up(spark, TRADES, f"{folder}/none", names(spark, "BTC"), f"{folder}/t").received == 0
    assert ledger.file_states(spark, f"{folder}/t").count() == 0
