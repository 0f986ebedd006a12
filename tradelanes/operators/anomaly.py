"""Seasonal baselines, z-scores, anomaly flags, share decline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.functions.scalar import col_of

# Anomaly thresholds on abs(z) and severity labels.
MEDIUM_Z = 2
HIGH_Z = 3
SEVERITY_LABELS = ("NORMAL", "MEDIUM", "HIGH")


def seasonal_baseline(df: DataFrame, season: str, columns: Mapping[str, str],
                      method: str = "aggregate") -> DataFrame:
    """Mean and sample standard deviation of each column per season.

    The frame is the whole season, including the tested row itself.  With
    ``method='aggregate'`` (default) the statistics come from a grouped
    aggregate - partial aggregation makes it indifferent to a season holding
    most of the rows - and are joined back; the statistics table has one row
    per season (12 months, 24 hours), and a NULL season is one of them.
    ``method='window'`` uses a full-partition window instead (one task per season).
    ``mergeable.add_to_baseline`` keeps the statistics up to date month by month.

    ``columns`` maps a metric column to the prefix of its statistics:
    ``{prefix}_mean`` and ``{prefix}_stddev``.
    """
    if method == "window":
        w = Window.partitionBy(season)
        out = df
        for c, p in columns.items():
            out = out.withColumn(f"{p}_mean", F.avg(c).over(w)).withColumn(f"{p}_stddev", F.stddev_samp(c).over(w))
        return out
    if method != "aggregate":
        raise ValueError(method)
    aggs = []
    for c, p in columns.items():
        aggs += [F.avg(c).alias(f"{p}_mean"), F.stddev_samp(c).alias(f"{p}_stddev")]
    stats = df.groupBy(F.col(season).alias("_season")).agg(*aggs)
    return df.join(stats, F.col(season).eqNullSafe(F.col("_season")), "left").drop("_season")


def zscore(value: str | Column, mean: str | Column, stddev: str | Column) -> Column:
    """``(value - mean) / nullif(stddev, 0)``: NULL for a constant season."""
    return (col_of(value) - col_of(mean)) / F.nullif(col_of(stddev), F.lit(0.0))


def flag_anomalies(zs: Sequence[Column], medium: float = MEDIUM_Z, high: float = HIGH_Z,
                   labels: Sequence[str] = SEVERITY_LABELS) -> tuple[Column, Column]:
    """Anomaly flag and severity from unrounded z-scores.

    Flag: any abs(z) strictly above ``medium``; a NULL comparison counts as
    false.  Severity: the largest abs(z) (``greatest`` skips NULLs) above
    ``high`` / above ``medium`` / else the normal label.
    """
    absz = [F.abs(z) for z in zs]
    any_over = None
    for a in absz:
        cond = a > F.lit(medium)
        any_over = cond if any_over is None else (any_over | cond)
    flag = F.when(any_over, F.lit(True)).otherwise(F.lit(False))
    worst = F.greatest(*absz) if len(absz) > 1 else absz[0]
    severity = (F.when(worst > F.lit(high), F.lit(labels[2]))
                .when(worst > F.lit(medium), F.lit(labels[1]))
                .otherwise(F.lit(labels[0])))
    return flag, severity


def share_decline_flag(df: DataFrame, category_col: str, category: str, share: str, prev_share: str,
                       points: float = 5.0, name: str = "decline_flag") -> DataFrame:
    """True when the row is ``category`` and its share fell by more than
    ``points`` against the previous row; NULL comparisons become false (W11)."""
    cond = (F.col(category_col) == F.lit(category)) & ((F.col(share) - F.col(prev_share)) < F.lit(-points))
    return df.withColumn(name, F.when(cond, F.lit(True)).otherwise(F.lit(False)))
