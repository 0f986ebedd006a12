"""Surrogate keys and deduplication (K1, K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.functions.scalar import surrogate_key


def with_surrogate_key(df: DataFrame, cols: Sequence[str], name: str, length_prefixed: bool = False,
                       first: bool = True) -> DataFrame:
    key = surrogate_key(cols, length_prefixed=length_prefixed).alias(name)
    return df.select(key, *df.columns) if first else df.select(*df.columns, key)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], method: str = "aggregate") -> DataFrame:
    """One row per key: the row that sorts first by ``order`` and then by all
    remaining columns (so the survivor is deterministic even for ties).

    ``method='aggregate'`` (default) takes ``min(struct(order..., rest...))`` per
    key: a declarative aggregate with a partial step, so a key holding a third
    of all rows is reduced map-side and never lands whole in one task.
    ``method='window'`` is the ``row_number() = 1`` form.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in list(order) + rest])
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    if method != "aggregate":
        raise ValueError(method)
    packed = F.min(F.struct(*[F.col(c) for c in list(order) + rest])).alias("_s")
    g = df.groupBy(*keys).agg(packed)
    return g.select(*[F.col(c) if c in keys else F.col(f"_s.{c}").alias(c) for c in df.columns])
