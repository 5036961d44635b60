"""The instrument catalog: dimensions, star join, upsert, and its queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.functions.times import instant_like
from tapelake.operators.dedup import first_per_key
from tapelake.plans.staging import stage
from tapelake.schemas import IDENTITY, INSTRUMENT_FIELDS

SYMBOL = ["base_asset", "quote_asset", "exchange"]


def natural_id(*parts: Column) -> Column:
    """A row's id is a digest of its natural key, so that every rerun gives the same id."""
    return F.md5(F.concat_ws("|", *parts))


def symbol_id() -> Column:
    return natural_id(*[F.col(c) for c in SYMBOL])


def instrument_id() -> Column:
    return natural_id(*[F.col(c) for c in IDENTITY])


# ---- dimensions -------------------------------------------------------------------------------------------------------
def exchange_names(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("exchange").alias("name")).distinct()


def asset_names(rows: DataFrame) -> DataFrame:
    """Base and quote assets together, each name once."""
    return rows.select(F.explode(F.array("base_asset", "quote_asset")).alias("name")).distinct()


def symbols_of(rows: DataFrame) -> DataFrame:
    return rows.select(*SYMBOL).distinct().select(symbol_id().alias("symbol_id"), *SYMBOL)


def ensure(existing: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing dimension rows plus the wanted ones that are not there yet."""
    return existing.unionByName(wanted.join(existing.select(*keys), list(keys), "left_anti"))


def ensure_dimensions(
    rows: DataFrame, exchanges: DataFrame, assets: DataFrame, symbols: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Insert-if-absent for the exchanges, assets and symbols that instrument rows mention."""
    return (
        ensure(exchanges, exchange_names(rows), ["name"]),
        ensure(assets, asset_names(rows), ["name"]),
        ensure(symbols, symbols_of(rows), SYMBOL),
    )


def instrument_view(instruments: DataFrame, symbols: DataFrame, exchanges: DataFrame, assets: DataFrame) -> DataFrame:
    """Instruments joined with symbol, exchange, base asset and quote asset: the 19 flat columns.

    All joins are inner equi-joins on unique keys. Which side is broadcast follows from the sizes Spark sees.
    """
    base = assets.select(F.col("name").alias("base_asset"))
    quote = assets.select(F.col("name").alias("quote_asset"))
    venue = exchanges.select(F.col("name").alias("exchange"))
    return (
        instruments.join(symbols, "symbol_id")
        .join(venue, "exchange")
        .join(base, "base_asset")
        .join(quote, "quote_asset")
        .select("instrument_id", "symbol_id", *IDENTITY, *INSTRUMENT_FIELDS)
    )


# ---- predicates -------------------------------------------------------------------------------------------------------
def has_identity(base_asset: str, quote_asset: str, exchange: str, instrument_type: str = "perpetual") -> Column:
    """All four parts equal, letter case included."""
    values = zip(IDENTITY, (base_asset, quote_asset, exchange, instrument_type))
    condition = F.lit(True)
    for column, value in values:
        condition = condition & (F.col(column) == value)
    return condition


def valid_at(at: Column) -> Column:
    """Listed by then and not yet expired: [listing, expiration), a null bound is open."""
    listed = F.col("listing").isNull() | (F.col("listing") <= at)
    return listed & (F.col("expiration").isNull() | (at < F.col("expiration")))


def currently_listed(now: Column | None = None) -> Column:
    """Active and not expired; the listing time is not looked at."""
    now = F.current_timestamp() if now is None else now
    return F.col("active") & (F.col("expiration").isNull() | (now < F.col("expiration")))


def available_on(day: Column, since: Column, to: Column) -> Column:
    """Day in [since, to), a null bound is open."""
    return (since.isNull() | (day >= since)) & (to.isNull() | (day < to))


def is_trading_date(day: Column, since: Column, to: Column) -> Column:
    """Day strictly between the ends, so both end days do not count; without both bounds false."""
    return F.coalesce((day > since) & (day < to), F.lit(False))


# ---- queries ----------------------------------------------------------------------------------------------------------
def current_instrument(view: DataFrame, requests: DataFrame, at: dt.datetime | dt.date | str | None = None) -> DataFrame:
    """The instrument of every requested identity, as of ``at`` if given, else at any time; latest listing first.

    An identity that is not found, or not valid then, gives no row.
    """
    rows = view if at is None else view.filter(valid_at(instant_like(view, "listing", at)))
    found = rows.join(requests.select(*IDENTITY).distinct(), IDENTITY, "left_semi")
    return first_per_key(found, IDENTITY, [F.desc_nulls_last("listing"), "instrument_id"])


def instrument_by_id(view: DataFrame, ids: DataFrame) -> DataFrame:
    return view.join(ids.select("instrument_id"), "instrument_id", "left_semi").select(*view.columns)


def list_instruments(
    view: DataFrame, exchange: str, instrument_type: str, now: dt.datetime | dt.date | str | None = None
) -> DataFrame:
    """Active, unexpired instruments of one exchange and type, by base and quote asset."""
    at = None if now is None else instant_like(view, "expiration", now)
    wanted = (F.col("exchange") == exchange) & (F.col("instrument_type") == instrument_type)
    return view.filter(wanted & currently_listed(at)).orderBy("base_asset", "quote_asset")


# ---- upsert -----------------------------------------------------------------------------------------------------------
def _merged(catalog: DataFrame, last: DataFrame, keys: list[str]) -> DataFrame:
    """The catalog after taking over ``last`` (one row per key), with ``action``."""
    columns = ["symbol_id", *IDENTITY, *INSTRUMENT_FIELDS]
    new = last.select(*keys, F.struct(*columns).alias("new"))
    held = catalog.select(
        *keys, F.struct(*columns).alias("held"), F.col("instrument_id").cast("string").alias("held_id")
    )
    # A whole row is taken from one side, so that a new null overwrites a held value.
    taken = F.coalesce("new", "held")
    action = F.when(F.col("new").isNull(), "kept").when(F.col("held").isNull(), "inserted").otherwise("updated")
    rows = held.join(new, keys, "full_outer").select("held_id", *[taken[c].alias(c) for c in columns], action.alias("action"))
    if keys == IDENTITY:
        return rows.select(F.coalesce("held_id", instrument_id()).alias("instrument_id"), *columns, "action")
    # An instrument that moved keeps its id, which is the digest of its first identity: whoever takes that identity
    # next gets a digest that tells its own key too.
    ids = catalog.select(F.col("instrument_id").cast("string").alias("_id"), F.lit(True).alias("_used"))
    rows = rows.withColumn("_id", instrument_id()).join(ids, "_id", "left")
    minted = F.when(F.col("_used"), natural_id(F.col("_id"), *[F.col(k) for k in keys])).otherwise(F.col("_id"))
    return rows.select(F.coalesce("held_id", minted).alias("instrument_id"), *columns, "action")


def _last_rows(rows: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return first_per_key(rows, keys, [F.desc(ordinal)]).withColumn("symbol_id", symbol_id())


def identity_conflicts(catalog: DataFrame, rows: DataFrame, keys: Sequence[str], ordinal: str = "ordinal") -> DataFrame:
    """The rows, one per key, that would give two instruments one identity, with ``reason``.

    Of several incoming rows of one identity the last counts; a row that meets an instrument which stays as it is, or stays
    because its own row was turned down, is turned down. What turning a row down brings about is looked at again until
    nothing changes: an exchange of identities is fine, a chain is turned down from the end that is blocked.
    """
    keys = list(keys)
    last = stage(_last_rows(rows, keys, ordinal), "upsert")
    refused = last.limit(0).select(*keys, F.lit("").alias("reason"))
    if keys == IDENTITY:
        return refused
    while True:
        accepted = last.join(refused.select(*keys), keys, "left_anti")
        stays = catalog.join(accepted.select(*keys), keys, "left_anti")
        blocked = accepted.join(stays.select(*IDENTITY), IDENTITY, "left_semi").select(*keys, F.lit("identity is held").alias("reason"))
        rank = F.row_number().over(Window.partitionBy(*IDENTITY).orderBy(F.desc(ordinal), *keys))
        doubled = accepted.withColumn("_rank", rank).filter(F.col("_rank") > 1).select(*keys, F.lit("identity comes twice").alias("reason"))
        more = stage(first_per_key(blocked.unionByName(doubled), keys, ["reason"]), "refused")
        if not more.limit(1).count():
            return refused
        refused = stage(refused.unionByName(more), "refused")


def upsert_instruments(
    catalog: DataFrame,
    rows: DataFrame,
    keys: Sequence[str] = IDENTITY,
    ordinal: str = "ordinal",
) -> DataFrame:
    """The catalog after inserting ``rows``, with ``action`` telling inserted, updated and kept rows apart.

    A row whose key is in the catalog overwrites every other column except the id, with nulls too; the last of several
    rows with one key (by ``ordinal``) counts. With keys (exchange, instrument_type, dataset) a row may also move its
    instrument to another symbol; rows that would give two instruments one identity are left out (see
    ``identity_conflicts``). No two instruments get one id.
    """
    keys = list(keys)
    last = _last_rows(rows, keys, ordinal)
    if keys != IDENTITY:
        last = last.join(identity_conflicts(catalog, rows, keys, ordinal).select(*keys), keys, "left_anti")
    return _merged(catalog, last, keys)


def upsert_counts(merged: DataFrame) -> DataFrame:
    """How many rows an upsert inserted, updated and kept."""
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("instruments"))


