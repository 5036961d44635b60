"""Pages of a large ordered table by position, without gathering the rows before them.

The rows are written once in the wanted order, cut into slices, each row with its place in its slice. The rows before each slice are a
running total over one row per slice. A page knows from that which slices and places it wants, and both are conditions of the scan:
row groups of other slices and places aren't read, and only the rows of the page are moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.plans.staging import path_exists

# Fixed: the lower bits of Spark's increasing ids count the rows of a task.
ROW_BITS = 33


@dataclass(frozen=True)
class Pages:
    """The pages of an indexed table; ``order`` are the columns its positions follow."""

    spark: SparkSession
    path: str
    order: tuple[str, ...]

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    @property
    def slices(self) -> DataFrame:
        """The slices in order: rows, and rows before."""
        return self.spark.read.parquet(f"{self.path}/slices")

    def __len__(self) -> int:
        return self.slices.agg(F.sum("row_count")).first()[0] or 0

    def page(self, count: int, skip: int = 0) -> DataFrame:
        """``count`` rows after the first ``skip``, with their ``position`` from 0 and in its order."""
        if count < 0 or skip < 0:
            raise ValueError("a page has neither a negative length nor a negative start")
        end = F.col("before") + F.col("row_count")
        wanted = self.slices.filter((F.col("before") < skip + count) & (end > skip)).orderBy("slice")
        # A page of many slices has them in a row, so the first and the last say all that the scan must know.
        first, last = wanted.agg(F.min_by(F.struct("slice", "before"), "slice"), F.max_by(F.struct("slice", "before"), "slice")).first()
        if first is None:
            rows, before = self.rows.filter(F.lit(False)), self.slices.filter(F.lit(False))
        else:
            after_start = (F.col("_slice") > first.slice) | (F.col("_place") >= skip - first.before)
            before_end = (F.col("_slice") < last.slice) | (F.col("_place") < skip + count - last.before)
            rows = self.rows.filter(F.col("_slice").between(first.slice, last.slice) & after_start & before_end)
            before = self.slices.filter(F.col("slice").between(first.slice, last.slice))
        before = before.select(F.col("slice").alias("_slice"), "before")
        placed = rows.join(before, "_slice").withColumn("position", F.col("before") + F.col("_place"))
        return placed.drop("_slice", "_place", "before").orderBy("position")


def index_pages(rows: DataFrame, path: str, *order: str, slices: int | None = None) -> Pages:
    """Write ``rows`` to ``path`` in the order of some columns, with the positions of their slices.

    The order should tell rows apart unless they are equal in every column: among ties the place is fixed when the index is
    written, not by the rows. Equal keys fall into one slice, so a key that many rows share calls for further columns.
    ``slices`` is the number of range partitions, by default the session's number of shuffle partitions.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    if not order:
        raise ValueError("pages need an order")
    dealt = rows.repartitionByRange(*([slices] if slices else []), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    numbered = dealt.withColumns({"_slice": F.shiftright(place, ROW_BITS), "_place": place.bitwiseAND(F.lit((1 << ROW_BITS) - 1))})
    numbered.write.parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # over one row per slice
    counted = stored.groupBy(F.col("_slice").alias("slice")).agg(F.count(F.lit(1)).alias("row_count"))
    before = F.coalesce(F.sum("row_count").over(earlier), F.lit(0)).alias("before")
    counted.select("slice", "row_count", before).coalesce(1).write.parquet(f"{path}/slices")
    return Pages(spark, path, tuple(order))


def open_pages(spark: SparkSession, path: str, order: Sequence[str]) -> Pages:
    """The pages of a table that was indexed before."""
    if not path_exists(spark, f"{path.rstrip('/')}/slices/_SUCCESS"):
        raise FileNotFoundError(f"{path} holds no whole page index")
    return Pages(spark, path.rstrip("/"), tuple(order))
