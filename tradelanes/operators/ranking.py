"""Ranks, percent ranks, composite score and top-N.

Global rankings have no partition key.  A plain ``Window.orderBy`` sends every
row to one task; that is offered as ``percent_ranks`` for inputs known to be
small.  ``percent_ranks_distributed`` computes the same numbers for inputs of
any size without a single-partition step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.operators.ordered import rows_ahead
from tradelanes.session import stored


def rank_within_distributed(df: DataFrame, period: str, value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Same ranks as ``rank_within`` for periods of any size (W4): one row for each distinct value of a period is
    range-partitioned and summed up, so a period is split over many tasks, and the ranks are joined back on the value."""
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    rows = stored(df, "rank_input")
    counts = rows.groupBy(period, value).agg(F.count(F.lit(1)).alias("n"))
    ranks = rows_ahead(counts, [period], value, order).select(
        F.col(period).alias("_period"), F.col(value).alias("_value"), (F.col("before") + 1).cast("bigint").alias(name))
    return (rows.join(ranks, F.col(period).eqNullSafe(F.col("_period")) & F.col(value).eqNullSafe(F.col("_value")))
            .drop("_period", "_value"))


def rank_within(df: DataFrame, period: str, value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """``rank()`` of ``value`` within each ``period`` (W4, periods known to be small: each is one task); NULLs first when
    descending and last when ascending, as PostgreSQL orders them."""
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    w = Window.partitionBy(period).orderBy(order)
    return df.withColumn(name, F.rank().over(w).cast("bigint"))


def percent_ranks(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``percent_rank() over (order by c asc nulls last)`` for each column (W5, small input)."""
    out = df
    for name, c in columns.items():
        out = out.withColumn(name, F.percent_rank().over(Window.orderBy(F.col(c).asc_nulls_last())))
    return out


def percent_ranks_distributed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Same values as ``percent_ranks`` for inputs of any size (W5, large input).

    percent_rank = rows strictly before the value / (rows - 1), NULLs last.  All columns go through
    one chain of steps, stacked as rows (column number, value):
    1. count rows per distinct value (a hot value is combined before the shuffle);
    2. range-partition and sort the distinct values once, as a written table that keeps each range's number;
    3. the rows of the ranges before give each range its offset (one row for each column and range);
    4. a running sum inside each range gives the rows before each value;
    5. join back on the value and turn the stack back into columns.
    Values compare as double.  The input is written first, so row numbers and ranges stay the same when a task
    runs again.
    """
    rows = stored(df, "rank_input").withColumn("_rid", F.monotonically_increasing_id())
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("v")) for k, c in enumerate(columns.values())])
    stack = rows.select("_rid", F.explode(pairs).alias("p")).select("_rid", "p.k", "p.v")
    counts = stack.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    table = (rows_ahead(counts, ["k"], "v", F.col("v").asc_nulls_last())
             .select("k", "v", F.when(F.col("all") <= 1, 0.0).otherwise(F.col("before").cast("double") / (F.col("all") - 1)).alias("pr")))
    ranks = (stack.alias("s").join(table.alias("t"), (F.col("s.k") == F.col("t.k")) & F.col("s.v").eqNullSafe(F.col("t.v")))
             .groupBy("s._rid").agg(*[F.max(F.when(F.col("s.k") == k, F.col("t.pr"))).alias(name) for k, name in enumerate(columns)]))
    return rows.join(ranks, "_rid").drop("_rid")


def composite_score(df: DataFrame, weights: Sequence[tuple[str, float]], name: str = "composite_score",
                    digits: int | None = 4, raw_name: str | None = None) -> DataFrame:
    """Weighted sum ``w1*c1 + w2*c2 + ...`` added left to right in the given
    order (ties depend on it).  Optionally keeps the unrounded sum as ``raw_name``."""
    expr = None
    for c, w in weights:
        term = F.lit(w) * F.col(c)
        expr = term if expr is None else expr + term
    expr = expr.cast("double")
    out = df
    if raw_name:
        out = out.withColumn(raw_name, expr)
        expr = F.col(raw_name)
    return out.withColumn(name, F.round(expr, digits) if digits is not None else expr)


def _sort_key_desc_nulls_first(v):
    return (0, 0) if v is None else (1, -v)


def top_ranked(df: DataFrame, score: str, n: int, name: str = "rank", distributed: bool = True) -> DataFrame:
    """Rows whose ``rank() over (order by score desc nulls first)`` is at most
    ``n`` (W7, L1); ties kept.  ``score`` must be numeric.

    ``distributed=True`` reads the n best scores with a top-n
    (TakeOrderedAndProject: each task keeps n rows, the driver gets n values).
    Every row that makes the cut has one of those values, and its rank is
    1 + the number of collected scores strictly ahead of it, so the rank is a
    CASE over at most n literals: no window and no single task, however many
    rows tie at the cut.  The frame is read twice: pass a written table.  ``distributed=False`` is the plain global window.
    """
    order = F.col(score).desc_nulls_first()
    if not distributed:
        ranked = df.withColumn(name, F.rank().over(Window.orderBy(order)).cast("bigint"))
        return ranked.where(F.col(name) <= n)
    scores = [r[0] for r in df.select(score).orderBy(order).limit(n).collect()]
    if not scores:
        return df.withColumn(name, F.lit(None).cast("bigint")).limit(0)
    keys = [_sort_key_desc_nulls_first(v) for v in scores]
    rank_expr = None
    for v in sorted(set(scores), key=_sort_key_desc_nulls_first):
        k = _sort_key_desc_nulls_first(v)
        r = 1 + sum(1 for x in keys if x < k)
        cond = F.col(score).isNull() if v is None else (F.col(score) == F.lit(v))
        rank_expr = F.when(cond, F.lit(r)) if rank_expr is None else rank_expr.when(cond, F.lit(r))
    if len(scores) < n:
        survivors = df
    elif scores[-1] is None:
        survivors = df.where(F.col(score).isNull())
    else:
        survivors = df.where(F.col(score).isNull() | (F.col(score) >= F.lit(scores[-1])))
    return survivors.withColumn(name, rank_expr.cast("bigint"))
