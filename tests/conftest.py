import gzip
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapelake.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tapelake-test-")


@pytest.fixture
def write_csv():
    """Write one gzip CSV file from a header and rows."""

    def write(path: str, header: str, *rows: str) -> str:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with gzip.open(path, "wt", encoding="utf-8") as out:
            out.write("\n".join([header, *rows]) + "\n")
        return path

    return write


@pytest.fixture
def write_json():
    def write(path: str, value) -> str:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as out:
            json.dump(value, out)
        return path

    return write


TRADES_HEADER = "exchange,symbol,timestamp,local_timestamp,id,side,price,amount"
LEVELS_HEADER = "exchange,symbol,timestamp,local_timestamp,is_snapshot,side,price,amount"
# 2024-01-15T00:00:00Z
MIDNIGHT = 1_705_276_800_000_000
DAY_MICROS = 86_400_000_000


@pytest.fixture
def trades_file(write_csv):
    """A day of trades with the odd cases a file may hold."""

    def write(path: str, symbol: str = "BTCUSDT", day: int = MIDNIGHT) -> str:
        return write_csv(
            path,
            TRADES_HEADER,
            f"binance-futures,{symbol},{day},{day + 5},1,buy,42000.5,0.000000000000000001",
            f"binance-futures,{symbol},{day + 1},{day + 6},2,sell,42000.25,1E-7",
            f"binance-futures,{symbol},{day + 1},{day + 6},2,sell,42000.25,1E-7",
            f"binance-futures,{symbol},,{day + 7},3,buy,42000,1",
            f"binance-futures,{symbol},{day + 2},{day + 8},4,BUY,42001,2",
            f"binance-futures,{symbol},{day + 3},{day + 9},5,,42002,0",
            f"binance-futures,{symbol},{day + DAY_MICROS - 1},{day + DAY_MICROS},6,unknown,42003,4",
        )

    return write


@pytest.fixture
def levels_file(write_csv):
    def write(path: str, symbol: str = "BTCUSDT", day: int = MIDNIGHT) -> str:
        return write_csv(
            path,
            LEVELS_HEADER,
            f"binance-futures,{symbol},{day + 10},{day + 20},true,bid,41999,1",
            f"binance-futures,{symbol},{day + 10},{day + 20},true,ask,42001,2",
            f"binance-futures,{symbol},{day + 5},{day + 21},false,ask,0,0",
            f"binance-futures,{symbol},{day + 7},{day + 22},false,BID,41998.5,3",
        )

    return write


@pytest.fixture
def instrument_json():
    """One element of an instrument list; keyword arguments replace fields."""

    def build(**changes) -> dict:
        row = {
            "datasetId": "BTCUSDT",
            "symbol": "btcusdt",
            "exchange": "ignored",
            "baseCurrency": "btc",
            "quoteCurrency": "usdt",
            "type": "perpetual",
            "active": True,
            "availableSince": "2024-01-01T00:00:00.000Z",
            "priceIncrement": 0.1,
            "amountIncrement": 0.001,
            "minTradeAmount": 0.001,
            "makerFee": 0.0002,
            "takerFee": 0.0004,
            "margin": True,
            "inverse": False,
            "contractMultiplier": 1,
            "listing": "2024-01-01T03:00:00+03:00",
            "expiry": None,
        }
        row.update(changes)
        return row

    return build
