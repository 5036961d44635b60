"""Schemas, keys and constraints, stated as data.

Nothing is inferred: raw files are read with the ``*_RAW`` schemas, tables are written with the ``*_FACT`` ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = T.DecimalType(38, 18)
FEE = T.DecimalType(12, 8)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# ---- raw files (column names and order are fixed by the file formats) -------------------------------------------------
TRADES_RAW = _struct(
    ("exchange", T.StringType()),
    ("symbol", T.StringType()),
    ("timestamp", T.LongType()),
    ("local_timestamp", T.LongType()),
    ("id", T.LongType()),
    ("side", T.StringType()),
    ("price", PRICE),
    ("amount", PRICE),
)

LEVELS_RAW = _struct(
    ("exchange", T.StringType()),
    ("symbol", T.StringType()),
    ("timestamp", T.LongType()),
    ("local_timestamp", T.LongType()),
    ("is_snapshot", T.BooleanType()),
    ("side", T.StringType()),
    ("price", PRICE),
    ("amount", PRICE),
)

# The list reply and its older spellings; times stay text because they come with Z, an offset, or neither.
INSTRUMENTS_RAW = _struct(
    ("datasetId", T.StringType()),
    ("dataset", T.StringType()),
    ("dataset_id", T.StringType()),
    ("symbol", T.StringType()),
    ("symbolId", T.StringType()),
    ("symbol_id", T.StringType()),
    ("id", T.StringType()),
    ("exchange", T.StringType()),
    ("baseCurrency", T.StringType()),
    ("quoteCurrency", T.StringType()),
    ("type", T.StringType()),
    ("instrumentType", T.StringType()),
    ("active", T.BooleanType()),
    ("availableSince", T.StringType()),
    ("available_from", T.StringType()),
    ("availableTo", T.StringType()),
    ("available_to", T.StringType()),
    ("priceIncrement", PRICE),
    ("amountIncrement", PRICE),
    ("minTradeAmount", PRICE),
    ("makerFee", FEE),
    ("takerFee", FEE),
    ("margin", T.BooleanType()),
    ("inverse", T.BooleanType()),
    ("contractMultiplier", PRICE),
    ("listing", T.StringType()),
    ("expiry", T.StringType()),
)

# ---- stored tables ----------------------------------------------------------------------------------------------------
TRADES_FACT = _struct(
    ("ts", T.TimestampType()),
    ("instrument_id", T.StringType()),
    ("side", T.ShortType()),
    ("price", PRICE),
    ("quantity", PRICE),
    ("trade_id", T.LongType()),
    ("trading_day", T.DateType()),
    ("instr_bucket", T.IntegerType()),
)

LEVELS_FACT = _struct(
    ("ts", T.TimestampType()),
    ("instrument_id", T.StringType()),
    ("side", T.ShortType()),
    ("price", PRICE),
    ("quantity", PRICE),
    ("is_snapshot", T.BooleanType()),
    ("update_seq", T.IntegerType()),
    ("trading_day", T.DateType()),
    ("instr_bucket", T.IntegerType()),
)

INSTRUMENT_FIELDS = [
    "dataset",
    "active",
    "available_since",
    "price_increment",
    "amount_increment",
    "min_trade_amount",
    "maker_fee",
    "taker_fee",
    "margin",
    "inverse",
    "contract_multiplier",
    "listing",
    "expiration",
]

# One flat row per instrument: identity, ids and the thirteen business fields.
INSTRUMENT = _struct(
    ("instrument_id", T.StringType()),
    ("symbol_id", T.StringType()),
    ("base_asset", T.StringType()),
    ("quote_asset", T.StringType()),
    ("exchange", T.StringType()),
    ("instrument_type", T.StringType()),
    ("dataset", T.StringType()),
    ("active", T.BooleanType()),
    ("available_since", T.TimestampType()),
    ("price_increment", PRICE),
    ("amount_increment", PRICE),
    ("min_trade_amount", PRICE),
    ("maker_fee", FEE),
    ("taker_fee", FEE),
    ("margin", T.BooleanType()),
    ("inverse", T.BooleanType()),
    ("contract_multiplier", PRICE),
    ("listing", T.TimestampType()),
    ("expiration", T.TimestampType()),
)

IDENTITY = ["base_asset", "quote_asset", "exchange", "instrument_type"]


@dataclass(frozen=True)
class Feed:
    """What the jobs need to know about one feed."""

    name: str  # the name used in requests
    tag: str  # the last part of a cached file's name
    segment: str  # the part of a source location
    raw: T.StructType
    fact: T.StructType
    ordinal: str  # the column that tells rows of one instant apart
    zero_price: bool  # may the price be zero

    # The column that tells most rows apart comes first: sorts by key then compare few columns (about 1.7 times faster).
    @property
    def key(self) -> list[str]:
        return ["ts", self.ordinal, "instrument_id"]

    @property
    def day_key(self) -> list[str]:
        return [self.ordinal, "trading_day", "instrument_id"]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fact if f.name != "instr_bucket"]

    @property
    def rest(self) -> list[str]:
        """Everything outside the key: the order that makes keep-first reproducible."""
        return [c for c in self.columns if c not in (*self.key, "trading_day")]


# Feed names, file tags, location segments.
TRADES = Feed("Trades", "trades", "trades", TRADES_RAW, TRADES_FACT, "trade_id", zero_price=False)
LEVELS = Feed("LevelUpdates", "l2", "incremental_book_L2", LEVELS_RAW, LEVELS_FACT, "update_seq", zero_price=True)
FEEDS = {f.name: f for f in (TRADES, LEVELS)}

# The instrument types a catalog row may have.
INSTRUMENT_TYPES = ["perpetual", "spot", "future"]
