"""Serving queries on the gold marts.

Ordering happens here only (never in stored marts).  Top-N queries carry the
group keys as tie-breakers so the N rows are always the same.  Values the
dashboards round after a cast to numeric are rounded as decimals here too.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.functions.scalar import band, col_of
from tradelanes.operators.measures import exact_avg
from tradelanes.operators.reshape import conditional_pivot

ARROW = " → "
# Display thresholds of the dashboards (growth colours and trend colours).
GROWTH_CUTS = (-5, 0, 5)
GROWTH_LABELS = ("red", "orange", "yellow", "green")
TREND_CUTS = (15, 30)
TREND_LABELS = ("red", "amber", "green")


def numeric_round(c: str | Column, digits: int, as_double: bool = True) -> Column:
    """``round(x::numeric, n)``: round a double through a decimal, half away from zero."""
    r = F.round(col_of(c).cast("decimal(38,10)"), digits)
    return r.cast("double") if as_double else r


def thousands(c: str | Column, digits: int = 2) -> Column:
    """``round((x / 1000)::numeric, n)`` for a decimal ``x``: exact shift, then round."""
    return F.round(col_of(c) * F.lit(Decimal("0.001")), digits).cast(f"decimal(38,{digits})")


def corridor_label(origin: str = "origin_name", dest: str = "destination_name") -> Column:
    # concat, not concat_ws: a missing name gives a NULL label, as the dashboard's || does.
    return F.concat(F.col(origin), F.lit(ARROW), F.col(dest))


def category_series(trends: DataFrame) -> DataFrame:
    """Tonnage per category and year, stamped at mid-year."""
    g = trends.groupBy("year", "commodity_category").agg(F.sum("total_tons").cast("decimal(38,2)").alias("total_tons"))
    return (g.select(F.make_date("year", F.lit(6), F.lit(15)).alias("time"), "commodity_category", "total_tons",
                     "year")
            .orderBy("year", F.col("commodity_category").asc_nulls_last()).drop("year"))


def scorecard_table(scorecard: DataFrame) -> DataFrame:
    """Scorecard with scaled and rounded display columns."""
    return scorecard.select(
        F.col("corridor_rank").alias("rank"),
        F.col("origin_name").alias("origin"),
        F.col("destination_name").alias("destination"),
        thousands("total_tons").alias("total_tons_m"),
        F.round("total_value", 0).cast("decimal(38,0)").alias("value_musd"),
        numeric_round("avg_yoy_growth_pct", 2).alias("avg_yoy_growth"),
        F.col("mode_count").alias("modes"),
        numeric_round("composite_score", 3).alias("score"),
    ).orderBy("rank", F.col("origin").asc_nulls_last(), F.col("destination").asc_nulls_last())


def _col_name(label: str) -> str:
    return label.lower().replace(" ", "_")


def mode_share_top(mode_share: DataFrame, year: int, tonnage_floor: float, mode_names: Sequence[str],
                   n: int = 5) -> DataFrame:
    """D3: mode share pivot for the ``n`` largest cross-zone corridors of a year."""
    f = mode_share.where((F.col("year") == year) & (F.col("origin_zone") != F.col("destination_zone"))
                         & (F.col("corridor_total_tons") > tonnage_floor))
    keys = ["origin_name", "destination_name"]
    p = conditional_pivot(f, keys, "mode_name", "mode_share_pct", [(m, _col_name(m)) for m in mode_names],
                          agg="max", extra=[F.max("corridor_total_tons").alias("_size")])
    order = [F.col("_size").desc_nulls_first(), F.col("origin_name").asc_nulls_last(),
             F.col("destination_name").asc_nulls_last()]
    return (p.orderBy(*order).limit(n)
            .select(corridor_label().alias("corridor"),
                    *[numeric_round(_col_name(m), 1).alias(_col_name(m)) for m in mode_names], *keys, "_size")
            .orderBy(*order).drop("_size", *keys))


def state_lanes(flows: DataFrame, year: int, state: str, n: int = 15) -> DataFrame:
    """Top ``n`` corridor x category flows out of one state, growth strictly inside (-100, 1000)."""
    f = flows.where((F.col("year") == year) & (F.col("origin_zone") != F.col("destination_zone"))
                    & (F.col("origin_state") == state)
                    & (F.col("yoy_growth_pct") > -100) & (F.col("yoy_growth_pct") < 1000))
    g = f.groupBy("origin_name", "destination_name", "commodity_category").agg(
        F.sum("total_tons").cast("decimal(38,2)").alias("_tons"),
        F.sum("total_value").cast("decimal(38,2)").alias("_value"),
        exact_avg("yoy_growth_pct").alias("_growth"))
    order = [F.col("_tons").desc_nulls_first(), F.col("origin_name").asc_nulls_last(),
             F.col("destination_name").asc_nulls_last(), F.col("commodity_category").asc_nulls_last()]
    top = g.orderBy(*order).limit(n)
    return top.orderBy(*order).select(
        corridor_label().alias("corridor"), F.col("commodity_category").alias("commodity"),
        thousands("_tons").alias("total_tons_m"), F.round("_value", 0).cast("decimal(38,0)").alias("value_musd"),
        numeric_round("_growth", 2).alias("yoy_growth"))


def indicator_series(disruption: DataFrame, since_year: int) -> DataFrame:
    """Indicator series since a year, rescaled to thousands."""
    return (disruption.where(F.col("year") >= since_year)
            .select(F.col("obs_date").alias("time"), "tsi_freight",
                    (F.col("truck_vmt") / 1000).alias("truck_vmt_k"),
                    (F.col("rail_carloads") / 1000).alias("rail_carloads_k"))
            .orderBy("time"))


def anomaly_events(disruption: DataFrame) -> DataFrame:
    """Anomaly annotations: time, severity text, tag."""
    return (disruption.where(F.col("is_anomaly"))
            .select(F.col("obs_date").alias("time"), F.col("severity").alias("text"), F.lit("anomaly").alias("tags"))
            .orderBy("time"))


def growth_bands(df: DataFrame, value: str = "yoy_growth_pct") -> DataFrame:
    """Display banding of growth: four classes around 0 and three trend classes."""
    return df.withColumn("growth_band", band(value, GROWTH_CUTS, GROWTH_LABELS)).withColumn(
        "trend_band", band(value, TREND_CUTS, TREND_LABELS))
