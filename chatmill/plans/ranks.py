"""Positions in a total order, found without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.plans.scratch import Scratch


#: Bytes read for a range.
RANGE_BYTES = 256 << 20


def range_count(rows: DataFrame) -> int:
    """Ranges that rows are split by: as many as shuffle partitions, or more where the size of what they are read from calls for it."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(50_000, size // RANGE_BYTES))


def with_position(rows: DataFrame, order: list[Column], name: str = "position", first: int = 0) -> DataFrame:
    """``rows`` with their rank in a total order, from ``first``; ``order`` must have no ties.

    Rows are split by ranges of the order and written once, since the ranges are sampled; then each range is numbered by
    itself and shifted by the sizes of those before it, of which there are as many as shuffle partitions.
    """
    scratch = Scratch(rows.sparkSession, "order")
    parts = range_count(rows)
    ranged = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    ranged = scratch.save("ranged", ranged)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_row", number).join(F.broadcast(before), "_part").withColumn(name, (F.col("_row") + F.col("_before") + (first - 1)).cast("long")).drop("_part", "_row", "_before")


def with_previous(rows: DataFrame, order: list[Column], columns: list[str], name: str = "place") -> DataFrame:
    """``rows`` with their place in a total order and the ``columns`` of the row before as prev_...; nulls for the first.

    In place of a lag over a key that may hold most rows: ranges of the order are looked at by themselves, and the first row of
    each is given the last of the range before.
    """
    scratch = Scratch(rows.sparkSession, "previous")
    ranged = scratch.save("ranged", rows.repartitionByRange(range_count(rows), *order).withColumn("_part", F.spark_partition_id()))
    # a row for each range
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", "_n", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    along = Window.partitionBy("_part").orderBy(*order)
    numbered = ranged.withColumn("_row", F.row_number().over(along)).withColumns({f"prev_{c}": F.lag(c).over(along) for c in columns}).join(F.broadcast(before), "_part")
    last = numbered.where(F.col("_row") == F.col("_n")).select("_part", F.struct(*columns).alias("_own"))
    border = scratch.save("border", last.select("_part", F.lag("_own").over(Window.orderBy("_part")).alias("_last")))
    placed = numbered.join(F.broadcast(border), "_part").withColumn(name, (F.col("_row") + F.col("_before") - 1).cast("long"))
    return placed.withColumns({f"prev_{c}": F.when(F.col("_row") == 1, F.col(f"_last.{c}")).otherwise(F.col(f"prev_{c}")) for c in columns}).drop("_part", "_n", "_row", "_before", "_last")


def with_running_sum(rows: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` up to each row in an order without ties, by ranges like ``with_position``."""
    scratch = Scratch(rows.sparkSession, "sums")
    ranged = scratch.save("ranged", rows.repartitionByRange(range_count(rows), *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.sum(value).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("_sum", inner).join(F.broadcast(before), "_part").withColumn(name, F.col("_sum") + F.col("_before")).drop("_part", "_sum", "_before")
