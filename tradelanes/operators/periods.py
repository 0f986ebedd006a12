"""Period operators: latest period (P5), previous value (W1), growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.functions.scalar import capped_growth_pct, growth_pct
from tradelanes.session import stored


def latest(df: DataFrame, period: str = "year", mode: str = "literal") -> DataFrame:
    """Rows of the newest period.

    ``mode='literal'`` reads the 1-row maximum first and filters with it as a
    literal, so the filter reaches the parquet scan and prunes year partitions
    of a stored mart.  ``mode='subquery'`` keeps it as an uncorrelated scalar
    subquery inside one plan, which runs what is behind ``df`` twice.
    ``mode='stored'`` is for a ``df`` that is computed: its rows are written once
    in a folder for each period, and of these only the newest is read back.
    """
    if mode == "stored":
        by_period = stored(df.hint("rebalance", F.col(period)), "by_period", period)
        return latest(by_period.select(*df.columns), period, "subquery")
    if mode == "subquery":
        return df.where(F.col(period) == df.select(F.max(period)).scalar())
    if mode != "literal":
        raise ValueError(mode)
    top = df.agg(F.max(period).alias("m")).first()["m"]
    return df.where(F.col(period) == F.lit(top))


def with_previous(df: DataFrame, value: str, keys: Sequence[str], order: str = "year",
                  name: str | None = None, strict_period: bool = False) -> DataFrame:
    """Value of the previous row of the same key.

    The previous *row*, not necessarily period - 1, exactly like ``lag``.  With
    ``strict_period=True`` the value is kept only when the previous row is the
    immediately preceding period.
    """
    name = name or f"prev_{value}"
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc())
    prev = F.lag(F.col(value)).over(w)
    if strict_period:
        prev_period = F.lag(F.col(order)).over(w)
        prev = F.when(prev_period == F.col(order) - 1, prev)
    return df.withColumn(name, prev)


def with_growth(df: DataFrame, value: str, keys: Sequence[str], order: str = "year",
                prev_name: str = "prev_year_tons", growth_name: str = "yoy_growth_pct",
                capped: bool = True, missing_base: str = "floor", strict_period: bool = False) -> DataFrame:
    """Previous value plus growth percent, from a single ``lag``."""
    out = with_previous(df, value, keys, order, prev_name, strict_period)
    g = (capped_growth_pct(value, prev_name, missing_base=missing_base) if capped
         else growth_pct(value, prev_name))
    return out.withColumn(growth_name, g)
