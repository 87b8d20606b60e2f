"""Surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.session import pin

# monotonically_increasing_id() holds the task number above bit 33 and the row number below.
_ROW_BITS = 33


def dense_numbers(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of the given columns.

    Range partitions are sorted on their own and written once, so that the counts and the
    numbers see the same partitions.  One count per partition is then added up.
    """
    placed = pin(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("_task", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_task")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_task")  # one row per partition
        .withColumn(name, F.lit(start) + F.col("_offset") + row)
        .select(name, *df.columns)
    )


def sparse_number(start: int = 1) -> Column:
    """Unique growing number with gaps, at no shuffle; fixed once the row is written."""
    return F.lit(start) + F.monotonically_increasing_id()
