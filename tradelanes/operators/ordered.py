"""Order within groups of any size: ranks and previous values without a task for each group.

A window over a group puts the group into one task.  Here the rows are range-partitioned by (group, order) and sorted once, as a
written table, so a large group is split over many ranges; what a range needs of the ranges before it (how many rows,
or which one was last) is one small row for each group and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.session import stored


def rows_ahead(counts: DataFrame, group: Sequence[str], value: str, order: Column, n: str = "n") -> DataFrame:
    """``counts`` (group, value, n rows; one row for each group and value) with ``before``, the rows of the group whose
    value comes first in ``order``, and ``all``, the rows of the group."""
    ranged = stored(counts.repartitionByRange(*group, order).select(*group, value, n, F.spark_partition_id().alias("part")), "ranges")
    parts = ranged.groupBy(*group, "part").agg(F.sum(n).alias("in_part"))
    up = Window.partitionBy(*group).orderBy("part")
    offsets = parts.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("part").alias("_part"), (F.sum("in_part").over(up) - F.col("in_part")).alias("_offset"),
                           F.sum("in_part").over(Window.partitionBy(*group)).alias("all"))
    inside = Window.partitionBy(*group, "part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("part") == F.col("_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return (ranged.withColumn("_inside", F.coalesce(F.sum(n).over(inside), F.lit(0))).join(offsets, same)
            .select(*group, value, n, (F.col("_offset") + F.col("_inside")).alias("before"), "all"))


def previous_in_order(df: DataFrame, group: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """``df`` with ``name``, the ``value`` of the row before it in its group by ``order`` (unique in the group), null for the
    first: a ``lag`` for groups of any size."""
    numbered = stored(df.repartitionByRange(*group, order).withColumn("_part", F.spark_partition_id()), "ordered")
    inside = Window.partitionBy(*group, "_part").orderBy(order)
    first = F.row_number().over(inside) == 1
    # The last value of every range, handed to the group's next range that has rows
    last = numbered.groupBy(*group, "_part").agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("last"))
    handed = last.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_p"),
                         F.lag("last.v").over(Window.partitionBy(*group).orderBy("_part")).alias("_handed"))
    same = F.col("_part") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    out = numbered.withColumn("_first", first).withColumn("_lag", F.lag(value).over(inside)).join(handed, same)
    return out.select(*df.columns, F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_lag")).alias(name))
