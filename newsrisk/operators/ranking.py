"""Row numbers and running sums over a whole table without a window in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsrisk.session import materialize


def global_running_sums(df: DataFrame, order: list, sums: dict) -> DataFrame:
    """``df`` with running sums, this row included, of the columns ``sums`` (new name: column) in the order of ``order``.

    Rows are dealt into ranges of ``order`` and summed within their range; the totals of the
    ranges before are added. Only those totals, one row per shuffle partition, meet in one task. Rows that
    are equal in all of ``order`` share a range and count in any order.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_range").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    totals = totals.select("_range", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumns({n: F.sum(c).over(within) for n, c in sums.items()}).join(F.broadcast(totals), "_range")  # one row per partition
    return summed.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_range", *(f"_{n}" for n in sums))


def global_row_number(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """``df`` with ``name`` (long, from 1): each row's place in the order of the columns ``order`` (see above)."""
    return global_running_sums(df, order, {name: F.lit(1).cast("long")})


def output_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in the order in which ``df`` gives its rows.

    Partitions are numbered in order, rows within them too; the partitions' counts give the rows before each.
    """
    width = 33  # monotonically_increasing_id: the partition above, the row below
    rows = materialize(df.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", width).alias("_part")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))  # one row per partition
    placed = rows.withColumn("_part", part).join(F.broadcast(counts), "_part")
    in_part = F.col("_id").bitwiseAND(F.lit((1 << width) - 1))
    return placed.withColumn(name, F.col("_before") + in_part + 1).drop("_id", "_part", "_before")
