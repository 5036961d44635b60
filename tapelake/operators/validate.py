"""The constraints the tables must satisfy, as filters with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.plans.staging import stage
from tapelake.schemas import INSTRUMENT_TYPES, Feed


def null_reason(columns: list[str]) -> Column:
    """``null <column>`` for the first null column, else null."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in columns])


def domain_reason(spec: Feed) -> Column:
    """Price positive (level updates also allow zero), quantity not negative."""
    low_price = F.col("price") < 0 if spec.zero_price else F.col("price") <= 0
    return F.when(low_price, "price out of range").when(F.col("quantity") < 0, "quantity out of range")


def check_domain(df: DataFrame, spec: Feed) -> DataFrame:
    """All rows with a ``reason`` column, null for a valid row."""
    return df.withColumn("reason", domain_reason(spec))


def check_not_null(df: DataFrame, spec: Feed) -> DataFrame:
    return df.withColumn("reason", null_reason([c for c in spec.columns if c in df.columns]))


def orphan_ids(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Instrument ids that facts use and the catalog does not have: usually none.

    They come from the distinct ids, so no fact row is shuffled by instrument to find them. The result is staged: its real
    size then tells Spark whether a join with it can be a broadcast.
    """
    ids = df.select("instrument_id").distinct().join(catalog.select("instrument_id"), "instrument_id", "left_anti")
    return stage(ids.filter(F.col("instrument_id").isNotNull()), "orphan-ids")


def orphans(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Fact rows whose instrument the catalog does not have."""
    return df.join(orphan_ids(df, catalog), "instrument_id", "left_semi").select(*df.columns)


def check_facts(df: DataFrame, spec: Feed, catalog: DataFrame | None = None) -> DataFrame:
    """Null, domain and (with a catalog) instrument checks together; the first reason found is given."""
    reason = F.coalesce(null_reason([c for c in spec.columns if c in df.columns]), domain_reason(spec))
    if catalog is None:
        return df.withColumn("reason", reason)
    unknown = orphan_ids(df, catalog)
    if unknown.isEmpty():
        return df.withColumn("reason", reason)
    return (
        df.join(unknown.withColumn("_orphan", F.lit(True)), "instrument_id", "left")
        .withColumn("reason", F.coalesce(reason, F.when(F.col("_orphan"), "unknown instrument")))
        .select(*df.columns, "reason")
    )


def instrument_reason() -> Column:
    """The catalog's CHECK rules: allowed type, positive increments, no negative fee, multiplier null or positive."""

    def not_positive(column: str) -> Column:
        return F.col(column).isNull() | (F.col(column) <= 0)

    def negative(column: str) -> Column:
        return F.col(column).isNull() | (F.col(column) < 0)

    bad_type = F.col("instrument_type").isNull() | ~F.col("instrument_type").isin(INSTRUMENT_TYPES)
    return (
        F.when(bad_type, "instrument type")
        .when(F.col("dataset").isNull(), "dataset")
        .when(F.col("active").isNull(), "active")
        .when(not_positive("price_increment"), "price increment")
        .when(not_positive("amount_increment"), "amount increment")
        .when(not_positive("min_trade_amount"), "minimum trade amount")
        .when(negative("maker_fee"), "maker fee")
        .when(negative("taker_fee"), "taker fee")
        .when(F.col("contract_multiplier") <= 0, "contract multiplier")
    )


def check_instruments(df: DataFrame) -> DataFrame:
    """All rows with a ``reason`` column, null for a valid row."""
    return df.withColumn("reason", instrument_reason())


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull()).drop("reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())
