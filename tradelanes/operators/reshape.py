"""Wide-to-long and long-to-wide reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_periods(df: DataFrame, ids: Sequence[str], measures: Sequence[str], periods: Sequence[int],
                    period_name: str = "year", fmt: str = "{measure}_{period}") -> DataFrame:
    """Wide to long over several measures at once.

    One scan: each input row becomes an array of one struct per period
    (period literal plus that period's measure columns), exploded in place.
    No shuffle; the row count grows by ``len(periods)``.
    """
    entries = [
        F.struct(F.lit(p).alias(period_name),
                 *[F.col(fmt.format(measure=m, period=p)).alias(m) for m in measures])
        for p in periods
    ]
    return (df.select(*ids, F.explode(F.array(*entries)).alias("_e"))
            .select(*ids, f"_e.{period_name}", *[f"_e.{m}" for m in measures]))


def unpivot_union(df: DataFrame, ids: Sequence[str], measures: Sequence[str], periods: Sequence[int],
                  period_name: str = "year", fmt: str = "{measure}_{period}") -> DataFrame:
    """The same result as a union of one projection per period (U1); kept as
    the cross-check of ``unpivot_periods`` - it scans the input once per period."""
    out = None
    for p in periods:
        part = df.select(*ids, F.lit(p).alias(period_name),
                         *[F.col(fmt.format(measure=m, period=p)).alias(m) for m in measures])
        out = part if out is None else out.unionByName(part)
    return out


def pivot_values(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str, values: Sequence[str],
                 agg: str = "max", names: Sequence[str] | None = None) -> DataFrame:
    """Long to wide with an explicit value list (R2, R3): one grouped aggregate,
    no extra job to discover the pivot values."""
    fn = {"max": F.max, "sum": F.sum, "min": F.min, "first": F.first}[agg]
    g = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(fn(F.col(value)))
    if names:
        for v, n in zip(values, names):
            g = g.withColumnRenamed(str(v), n)
    return g


def conditional_pivot(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str,
                      mapping: Sequence[tuple[str, str]], agg: str = "max", extra: Sequence[Column] = ()) -> DataFrame:
    """``agg(case when pivot_col = v then value end) as name`` for each (v, name):
    the conditional-aggregate spelling of the same pivot, in one aggregate
    together with any ``extra`` aggregate columns."""
    fn = {"max": F.max, "sum": F.sum, "min": F.min}[agg]
    return df.groupBy(*keys).agg(*[fn(F.when(F.col(pivot_col) == F.lit(v), F.col(value))).alias(n)
                                   for v, n in mapping], *extra)
