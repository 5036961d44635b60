"""Exchange names, codes and slugs, and instrument types, as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelake.schemas import INSTRUMENT_TYPES

# Bit per market segment and per venue.
SPOT, FUTURES, CURRENCY, SWAP = 1, 2, 4, 8
BINANCE, OKEX, MOEX, KUCOIN = 16, 32, 64, 128

# The code of every exchange name.
EXCHANGE_CODES = {
    "None": 0,
    "Spot": SPOT,
    "Futures": FUTURES,
    "Currency": CURRENCY,
    "Swap": SWAP,
    "Binance": BINANCE,
    "Okex": OKEX,
    "Moex": MOEX,
    "Kucoin": KUCOIN,
    "MoexFutures": MOEX | FUTURES,
    "MoexSpot": MOEX | SPOT,
    "MoexSelt": MOEX | CURRENCY,
    "BinanceSpot": BINANCE | SPOT,
    "BinanceFutures": BINANCE | FUTURES,
    "OkexSpot": OKEX | SPOT,
    "OkexFutures": OKEX | FUTURES,
    "OkexSwap": OKEX | SWAP,
    "KucoinSpot": KUCOIN | SPOT,
    "KucoinFutures": KUCOIN | FUTURES,
    "Crypto": BINANCE | OKEX | KUCOIN,
    "Classic": MOEX,
}

# The canonical slugs. A name without one is its own slug.
SLUGS = {
    "BinanceSpot": "binance",
    "BinanceFutures": "binance-futures",
    "OkexSpot": "okex",
    "OkexFutures": "okex-futures",
    "OkexSwap": "okex-swap",
    "KucoinSpot": "kucoin",
    "KucoinFutures": "kucoin-futures",
}

# The slugs of the downloader (looked up by lower-case name), the importer and the catalog refresh.
DOWNLOAD_SLUGS = {
    "binancefutures": "binance-futures",
    "binancespot": "binance",
    "okex": "okex",
    "okexfutures": "okex-futures",
    "okexswap": "okex-swap",
    "kucoinfutures": "kucoin-futures",
    "kucoinspot": "kucoin",
}
IMPORT_SLUGS = {
    "BinanceFutures": "binance-futures",
    "BinanceSpot": "binance-spot",
    "OkexFutures": "okx-futures",
    "OKXFutures": "okx-futures",
    "OkxFutures": "okx-futures",
    "OkexSpot": "okx-spot",
    "OKXSpot": "okx-spot",
    "OkxSpot": "okx-spot",
    "KucoinFutures": "kucoin-futures",
    "KucoinSpot": "kucoin-spot",
}
REFRESH_SLUGS = {
    "BinanceFutures": "binance-futures",
    "BinanceSpot": "binance-spot",
    "OkexFutures": "okex-futures",
    "OkexSpot": "okex-spot",
    "KucoinFutures": "kucoin-futures",
    "KucoinSpot": "kucoin-spot",
}


def _lookup(table: dict, key: Column) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))[key]


def exchange_code(name: Column) -> Column:
    """The bit code of an exchange name, null for an unknown one."""
    return _lookup(EXCHANGE_CODES, name).cast("bigint")


def in_group(code: Column, group: str) -> Column:
    """Does the code share a bit with the named group (``Crypto``, ``Classic``, ``Spot``, ...)?"""
    return code.bitwiseAND(F.lit(EXCHANGE_CODES[group]).cast("bigint")) != 0


def exchange_slug(name: Column, style: str = "canonical") -> Column:
    """Exchange name to the slug used in locations; ``style`` selects one of the four historical tables."""
    if style == "canonical":
        return F.coalesce(_lookup(SLUGS, name), name)
    if style == "download":
        key = F.lower(F.trim(name))
        return F.coalesce(_lookup(DOWNLOAD_SLUGS, key), key)
    if style == "import":
        return F.coalesce(_lookup(IMPORT_SLUGS, name), F.translate(F.lower(name), "_", "-"))
    if style == "refresh":
        return F.coalesce(_lookup(REFRESH_SLUGS, name), F.lower(name))
    raise ValueError(f"unknown slug style: {style}")


def slug_exchange(slug: Column) -> Column:
    """Canonical slug back to the exchange name, null (to be rejected) for an unknown slug."""
    named = {EXCHANGE: EXCHANGE for EXCHANGE in EXCHANGE_CODES if EXCHANGE not in SLUGS}
    return _lookup({**named, **{slug: name for name, slug in SLUGS.items()}}, slug)


def instrument_type(text: Column, aliases: bool = False) -> Column:
    """Trimmed lower-case type if it is an allowed one, else null; with ``aliases`` swap and perp mean perpetual."""
    value = F.lower(F.trim(text))
    if aliases:
        value = F.when(value.isin("swap", "perp"), "perpetual").otherwise(value)
    return F.when(value.isin(INSTRUMENT_TYPES), value)


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def upper_or_empty(value: Column) -> Column:
    return F.upper(F.coalesce(value, F.lit("")))
