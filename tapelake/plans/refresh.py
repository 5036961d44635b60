"""Catalog refresh: instrument list to catalog table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.times import iso_timestamp
from tapelake.functions.venues import instrument_type, upper_or_empty
from tapelake.operators.catalog import upsert_counts, upsert_instruments
from tapelake.operators.validate import check_instruments, rejected, valid
from tapelake.plans.staging import stage
from tapelake.schemas import IDENTITY, INSTRUMENT_FIELDS
from tapelake.sources.facts import read_catalog


def catalog_rows(raw: DataFrame, fill: bool = True) -> DataFrame:
    """Instrument-list rows to catalog columns plus ``ordinal`` (their order).

    Names are upper-cased, times without a zone are UTC. With ``fill`` a missing flag means active and missing increments
    and fees are 0 (a 0 increment then fails its check).
    """
    zero = F.lit(0)

    def number(column: str, kind: str) -> Column:
        value = F.col(column)
        return (F.coalesce(value, zero) if fill else value).cast(kind)

    price, fee = "decimal(38,18)", "decimal(12,8)"
    active = F.coalesce(F.col("active"), F.lit(True)) if fill else F.col("active")
    ordinal = F.col("ordinal") if "ordinal" in raw.columns else F.monotonically_increasing_id()
    return raw.select(
        upper_or_empty(F.col("baseCurrency")).alias("base_asset"),
        upper_or_empty(F.col("quoteCurrency")).alias("quote_asset"),
        "exchange",
        instrument_type(F.col("type"), aliases=True).alias("instrument_type"),
        upper_or_empty(F.col("datasetId")).alias("dataset"),
        active.alias("active"),
        iso_timestamp(F.col("availableSince")).alias("available_since"),
        number("priceIncrement", price).alias("price_increment"),
        number("amountIncrement", price).alias("amount_increment"),
        number("minTradeAmount", price).alias("min_trade_amount"),
        number("makerFee", fee).alias("maker_fee"),
        number("takerFee", fee).alias("taker_fee"),
        "margin",
        "inverse",
        F.col("contractMultiplier").alias("contract_multiplier"),
        iso_timestamp(F.col("listing")).alias("listing"),
        iso_timestamp(F.col("expiry")).alias("expiration"),
        ordinal.alias("ordinal"),
    )


def complete(rows: DataFrame) -> DataFrame:
    """Rows with data set, base, quote and an allowed type; others are silently left out of a refresh."""
    named = (F.col("dataset") != "") & (F.col("base_asset") != "") & (F.col("quote_asset") != "")
    return rows.filter(named & F.col("instrument_type").isNotNull())


def refreshed(catalog: DataFrame, raw: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The catalog after a refresh, with ``action``; rows that break a check are not taken over."""
    rows = valid(check_instruments(complete(catalog_rows(raw))))
    return upsert_instruments(catalog, rows, keys or IDENTITY)


def refresh_rejects(raw: DataFrame) -> DataFrame:
    return rejected(check_instruments(complete(catalog_rows(raw))))


class RefreshRejected(ValueError):
    """The list breaks a catalog check; nothing was written."""


def refresh_instruments(
    spark: SparkSession, raw: DataFrame, exchange: str, path: str, on_invalid: str = "reject"
) -> dict[str, int]:
    """Upsert one exchange's instruments into the catalog table at ``path`` and return the counts per action.

    Rows that break a check are left out and counted as ``rejected``, or with ``on_invalid="fail"`` stop the refresh. The new
    state is staged before it replaces the exchange's partition, so the table is never read and overwritten by one job. An
    empty list changes nothing.
    """
    listed = raw.filter(F.col("exchange") == exchange)
    rejects = refresh_rejects(listed).count()
    if rejects and on_invalid == "fail":
        raise RefreshRejected(f"{rejects} instruments of {exchange} break a check")
    catalog = read_catalog(spark, path).filter(F.col("exchange") == exchange)
    merged = stage(refreshed(catalog, listed), "catalog")
    counts = {r.action: r.instruments for r in upsert_counts(merged).collect()}
    if set(counts) - {"kept"}:
        (
            merged.select("instrument_id", "symbol_id", *IDENTITY, *INSTRUMENT_FIELDS)
            .hint("rebalance", F.col("exchange"))
            .write.partitionBy("exchange")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(path)
        )
    return {**counts, **({"rejected": rejects} if rejects else {})}
