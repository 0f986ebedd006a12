"""Aggregations (A1-A5) and share of total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.functions.scalar import col_of, safe_ratio

# Sums of decimal(18,2) inputs are widened to this type on output.
SUM_TYPE = "decimal(38,2)"


def rollup_measures(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str | Column],
                    as_type: str | None = SUM_TYPE) -> DataFrame:
    """Multi-key sum of several measures in one aggregate (A1).

    Spark plans a partial aggregate before the shuffle, so a key holding a
    large share of the rows is combined on the map side.
    """
    aggs = []
    for out, src in measures.items():
        s = F.sum(col_of(src))
        aggs.append((s.cast(as_type) if as_type else s).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                    pre_aggregate: bool = True) -> DataFrame:
    """Several ``count(distinct c)`` per group (A2).

    With ``pre_aggregate`` each column is first reduced to its distinct
    (keys, c) pairs, counted, and the per-column results are joined on the
    keys; this avoids Spark's Expand, which replicates every input row once
    per distinct column.  Without it, Spark's own ``count_distinct`` is used.
    """
    if not pre_aggregate:
        return df.groupBy(*keys).agg(*[F.count_distinct(F.col(c)).alias(o) for o, c in columns.items()])
    out = None
    for o, c in columns.items():
        part = (df.where(F.col(c).isNotNull()).select(*keys, c).distinct()
                .groupBy(*keys).agg(F.count(F.lit(1)).alias(o)))
        out = part if out is None else out.join(part, on=list(keys), how="full")
    return out.fillna(0, subset=list(columns))


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """Average of a column that holds values with at most ``scale`` decimals.

    Summed as a decimal (exact, order independent), divided in double: the
    result is the same on any engine and any partitioning.  NULLs are skipped;
    an all-NULL group gives NULL.
    """
    x = col_of(c).cast(f"decimal(18,{scale})")
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0)).cast("double")


def share_of_total(df: DataFrame, total_keys: Sequence[str], value: str, total_name: str,
                   share_name: str | None = None, digits: int = 2, scale: float = 100.0) -> DataFrame:
    """Attach the total of ``value`` over ``total_keys`` and the share of it.

    Expressed as a window sum over the total keys rather than a join back to
    a separate aggregate: same rows, one exchange instead of two.  Each window
    partition holds the parts of one total (bounded by the part domain).
    """
    w = Window.partitionBy(*total_keys)
    out = df.withColumn(total_name, F.sum(F.col(value)).over(w))
    if share_name:
        out = out.withColumn(share_name, safe_ratio(value, total_name, digits, scale))
    return out
