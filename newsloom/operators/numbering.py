"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def numbered(df: DataFrame, order: Sequence[str], name: str,
             column: str = "position") -> DataFrame:
    """Add ``column``: the row's place (from 0) in the order of ``order``.

    Rows must differ in ``order``.  They are dealt out by range, numbered within
    each range, and moved up by the size of the ranges before it.  The ranges
    are stored, so both readings agree.
    """
    ranged = cut_lineage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    inside = Window.partitionBy("_range").orderBy(*order)
    # One row per range: as many as there were tasks.
    before = (ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
              .withColumn("_before", F.coalesce(
                  F.sum("_rows").over(Window.orderBy("_range").rowsBetween(
                      Window.unboundedPreceding, -1)), F.lit(0)))
              .select("_range", "_before"))
    return (ranged.withColumn("_inside", F.row_number().over(inside))
            .join(before, "_range")
            .withColumn(column, (F.col("_before") + F.col("_inside") - 1).cast("long"))
            .drop("_range", "_inside", "_before"))
