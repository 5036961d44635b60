"""Side text to side code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Side codes. -1 sells or asks, 1 buys or bids, 0 is undefined; the script coding has 1 and 2.
SHORT, UNDEFINED, LONG = -1, 0, 1
SCRIPT_BUY, SCRIPT_SELL = 1, 2


def trade_side(side: Column) -> Column:
    """Exact ``sell`` and ``buy``; every other text, and null, is undefined."""
    return F.when(side == "sell", SHORT).when(side == "buy", LONG).otherwise(UNDEFINED).cast("smallint")


def order_side(side: Column) -> Column:
    """Exact ``ask`` and ``bid``; every other text, and null, is undefined."""
    return F.when(side == "ask", SHORT).when(side == "bid", LONG).otherwise(UNDEFINED).cast("smallint")


def script_side(side: Column, feed_tag: str) -> Column:
    """The coding of the offline import: any letter case, 1 and 2, null for an unknown side."""
    buy, sell = ("buy", "sell") if feed_tag == "trades" else ("bid", "ask")
    return F.when(F.lower(side) == buy, SCRIPT_BUY).when(F.lower(side) == sell, SCRIPT_SELL).cast("smallint")
