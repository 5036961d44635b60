"""Raw rows to fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.sides import order_side, script_side, trade_side
from tapelake.functions.times import micros_to_timestamp, trading_day
from tapelake.operators.sequence import GROUP_ROWS, number_consecutive, number_rows
from tapelake.schemas import LEVELS, TRADES, Feed

# The order of the sorted numbering. The last two columns only separate rows the first four tie on.
SORTED_ORDER = ["timestamp", "local_timestamp", "price", "amount", "side", "is_snapshot"]


def with_raw_time(raw: DataFrame) -> DataFrame:
    """Rows that carry an event time; rows without one are not loaded."""
    return raw.filter(F.col("timestamp").isNotNull())


def without_raw_time(raw: DataFrame) -> DataFrame:
    """The rows ``with_raw_time`` leaves out, for the reject report."""
    return raw.filter(F.col("timestamp").isNull())


def _side(spec: Feed, side_coding: str) -> Column:
    if side_coding == "service":
        return trade_side(F.col("side")) if spec is TRADES else order_side(F.col("side"))
    if side_coding == "script":
        return script_side(F.col("side"), spec.tag)
    raise ValueError(f"unknown side coding: {side_coding}")


def _common(raw: DataFrame, spec: Feed, side_coding: str) -> DataFrame:
    ts = micros_to_timestamp(F.col("timestamp"))
    return raw.withColumns(
        {
            "ts": ts,
            "trading_day": trading_day(ts),
            "side": _side(spec, side_coding),
            "quantity": F.col("amount"),
        }
    )


def normalize_trades(raw: DataFrame, side_coding: str = "service", keep: Sequence[str] = (), timed: bool = True) -> DataFrame:
    """Raw trades with an ``instrument_id`` column to fact columns, and those to ``keep``; rows without a time stay unless ``timed``."""
    rows = _common(with_raw_time(raw) if timed else raw, TRADES, side_coding).withColumnRenamed("id", "trade_id")
    return rows.select(*TRADES.columns, *keep)


def normalize_levels(raw: DataFrame, side_coding: str = "service", keep: Sequence[str] = (), timed: bool = True) -> DataFrame:
    """Raw level updates with ``instrument_id`` and ``update_seq`` columns to fact columns, and those to ``keep``; rows without a time
    stay unless ``timed``."""
    return (
        _common(with_raw_time(raw) if timed else raw, LEVELS, side_coding)
        .withColumn("is_snapshot", F.coalesce(F.col("is_snapshot"), F.lit(False)))
        .select(*LEVELS.columns, *keep)
    )


def sequence_sorted(raw: DataFrame, source: list[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """1-based ``update_seq`` in event order within one source (a file), reproducible from the rows alone."""
    return number_rows(with_raw_time(raw), source, SORTED_ORDER, start=1, group_rows=group_rows)


def sequence_arrival(
    raw: DataFrame, source: list[str], arrival: str = "_arrival", group_rows: int = GROUP_ROWS, unique: bool = False
) -> DataFrame:
    """0-based ``update_seq`` in arrival order within one source; ``unique`` says that no two rows of a source have one arrival."""
    if unique:
        return number_consecutive(with_raw_time(raw), source, arrival, start=0, group_rows=group_rows)
    return number_rows(with_raw_time(raw), source, [arrival], start=0, group_rows=group_rows)
