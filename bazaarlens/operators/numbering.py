"""Numbers in a global order, without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_PART, _SHIFT = "_part", "_shift"


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, 3, .. in the given order.

    Rows are sorted by ranges and written once with the number of their range. They are numbered within
    ranges and shifted by the sizes of the ranges before; only one size per range meets in one place.
    """
    ranges = written(rows.orderBy(*order).withColumn(_PART, F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy(_PART).agg(F.count("*").alias("_size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(_PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias(_SHIFT))
    within = Window.partitionBy(_PART).orderBy(*order)
    return (
        ranges.join(F.broadcast(shifts), _PART)  # two numbers per range of the sort
        .withColumn(name, F.col(_SHIFT) + F.row_number().over(within))
        .drop(_PART, _SHIFT)
    )
