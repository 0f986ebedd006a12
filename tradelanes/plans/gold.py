"""Gold marts (G1-G5) composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelanes.operators.anomaly import flag_anomalies, seasonal_baseline, share_decline_flag, zscore
from tradelanes.operators.enrich import enrich_lanes
from tradelanes.operators.measures import SUM_TYPE, distinct_counts, exact_avg, rollup_measures, share_of_total
from tradelanes.operators.periods import latest, with_growth, with_previous
from tradelanes.operators.ranking import (
    composite_score,
    percent_ranks,
    percent_ranks_distributed,
    rank_within,
    top_ranked,
)
from tradelanes.functions.scalar import safe_ratio
from tradelanes.session import stored

LANE_KEYS = ["origin_zone", "destination_zone", "commodity_code", "mode_code"]
CORRIDOR_ATTRS = ["origin_zone", "destination_zone", "origin_name", "destination_name",
                  "origin_state", "destination_state"]
LANE_FLOW_COLUMNS = CORRIDOR_ATTRS + [
    "commodity_code", "commodity_name", "commodity_category",
    "mode_code", "mode_name", "mode_category", "year",
    "total_tons", "total_value", "total_tmiles", "prev_year_tons", "yoy_growth_pct",
]
# Scorecard weights, in the order they are added.
SCORE_WEIGHTS = [("volume_pct_rank", 0.35), ("value_pct_rank", 0.30),
                 ("growth_pct_rank", 0.25), ("diversity_pct_rank", 0.10)]
SCORECARD_TOP = 25
SHARE_DECLINE_POINTS = 5.0


def lane_flows(shipments: DataFrame, regions: DataFrame, commodities: DataFrame, modes: DataFrame,
               missing_base: str = "floor", strict_period: bool = False) -> DataFrame:
    """G1: tonnage, value and ton-miles per lane and year with capped growth.

    Aggregates on the codes first and attaches the dimension attributes to the
    (much smaller) aggregate; valid because dimension keys are unique (checked
    by the quality rules).  The sum is partial + final, so a hot lane is
    combined before the shuffle; the growth window then sees at most one row
    per lane and year.
    """
    totals = rollup_measures(shipments, LANE_KEYS + ["year"],
                             {"total_tons": "tons", "total_value": "value", "total_tmiles": "tmiles"})
    enriched = enrich_lanes(totals, regions, commodities, modes)
    out = with_growth(enriched, "total_tons", LANE_KEYS, "year", "prev_year_tons", "yoy_growth_pct",
                      capped=True, missing_base=missing_base, strict_period=strict_period)
    return out.select(*LANE_FLOW_COLUMNS)


def commodity_trends(flows: DataFrame) -> DataFrame:
    """Per commodity and year: sums, value per ton, tonnage rank, uncapped growth."""
    g = rollup_measures(flows, ["commodity_code", "commodity_name", "commodity_category", "year"],
                        {"total_tons": "total_tons", "total_value": "total_value", "total_tmiles": "total_tmiles"})
    g = g.withColumn("value_per_ton", safe_ratio("total_value", "total_tons", 4))
    g = rank_within(g, "year", "total_tons", "tonnage_rank", descending=True)
    g = with_growth(g, "total_tons", ["commodity_code"], "year", "prev_year_tons", "yoy_growth_pct", capped=False)
    return g.select("commodity_code", "commodity_name", "commodity_category", "year", "total_tons",
                    "total_value", "total_tmiles", "value_per_ton", "tonnage_rank", "prev_year_tons",
                    "yoy_growth_pct")


def mode_share(flows: DataFrame, decline_mode: str, points: float = SHARE_DECLINE_POINTS,
               share_partitioning: bool = True) -> DataFrame:
    """Share of each mode in its corridor and year, previous share, decline flag.

    With ``share_partitioning`` the lane flows are hash-partitioned once on
    (origin_zone, destination_zone); the mode aggregate and both windows are
    keyed on supersets of that, so no further exchange is planned.  The flows
    are already aggregated per lane and year, so a corridor holds at most
    commodities x modes x years rows: no skew from a hot corridor.
    """
    src = flows.repartition("origin_zone", "destination_zone") if share_partitioning else flows
    keys = CORRIDOR_ATTRS + ["mode_code", "mode_name", "mode_category", "year"]
    m = rollup_measures(src, keys, {"mode_tons": "total_tons"})
    m = share_of_total(m, ["origin_zone", "destination_zone", "year"], "mode_tons", "corridor_total_tons",
                       "mode_share_pct", digits=2, scale=100.0)
    m = m.where(F.col("corridor_total_tons") > 0)
    m = with_previous(m, "mode_share_pct", ["origin_zone", "destination_zone", "mode_code"], "year",
                      "prev_year_share_pct")
    m = share_decline_flag(m, "mode_name", decline_mode, "mode_share_pct", "prev_year_share_pct", points,
                           "truck_share_decline_flag")
    return m.select(*keys, "mode_tons", F.col("corridor_total_tons").cast(SUM_TYPE).alias("corridor_total_tons"),
                    "mode_share_pct", "prev_year_share_pct", "truck_share_decline_flag")


def corridor_summary(flows: DataFrame, pre_aggregate_distinct: bool = False) -> DataFrame:
    """Per corridor and year: sums, distinct modes and commodities, average growth.

    The lane flows hold one row per (corridor, commodity, mode, year), a table
    bounded by the dimension domains, so the two ``count(distinct)`` run in the
    same aggregate (Spark's Expand triples those rows) and the flows are
    computed once.  ``pre_aggregate_distinct=True`` is the form for inputs
    that are not yet at that grain: a distinct pre-aggregate per column,
    joined on the keys.
    """
    keys = CORRIDOR_ATTRS + ["year"]
    sums = flows.groupBy(*keys).agg(
        F.sum("total_tons").cast(SUM_TYPE).alias("total_tons"),
        F.sum("total_value").cast(SUM_TYPE).alias("total_value"),
        F.sum("total_tmiles").cast(SUM_TYPE).alias("total_tmiles"),
        exact_avg("yoy_growth_pct").alias("avg_yoy_growth_pct"),
        *([] if pre_aggregate_distinct else [
            F.count_distinct("mode_code").alias("mode_count"),
            F.count_distinct("commodity_code").alias("commodity_count")]),
    )
    if not pre_aggregate_distinct:
        return sums
    d = distinct_counts(flows, ["origin_zone", "destination_zone", "year"],
                        {"mode_count": "mode_code", "commodity_count": "commodity_code"})
    return sums.join(d, ["origin_zone", "destination_zone", "year"], "left")


def lane_scorecard(flows: DataFrame, top_n: int = SCORECARD_TOP, rank_method: str = "distributed",
                   latest_mode: str = "literal") -> DataFrame:
    """Latest-year cross-zone corridors ranked by a weighted percentile score.

    The corridor summary and then the scored corridors are written tables, so neither the flows nor the ranks
    are computed twice; the latest year is read from the first as a literal filter.  ``rank_method='window'``
    ranks with global windows, for inputs known to be small.
    """
    # The summary of all years (corridors x years rows) is written once; the
    # newest year is then read from those files, so the flows run only once.
    s = stored(corridor_summary(flows), "corridor_summary")
    s = latest(s, "year", mode=latest_mode).where(F.col("origin_zone") != F.col("destination_zone"))
    cols = {"volume_pct_rank": "total_tons", "value_pct_rank": "total_value",
            "growth_pct_rank": "avg_yoy_growth_pct", "diversity_pct_rank": "mode_count"}
    if rank_method == "window":
        ranked = percent_ranks(s, cols)
    elif rank_method == "distributed":
        ranked = percent_ranks_distributed(s, cols)
    else:
        raise ValueError(rank_method)
    scored = stored(composite_score(ranked, SCORE_WEIGHTS, "composite_score", 4, raw_name="_raw_score"), "scored")
    top = top_ranked(scored, "_raw_score", top_n, "corridor_rank")
    return top.select(*CORRIDOR_ATTRS, "year", "total_tons", "total_value", "total_tmiles", "mode_count",
                      "commodity_count", "avg_yoy_growth_pct", "volume_pct_rank", "value_pct_rank",
                      "growth_pct_rank", "diversity_pct_rank", "composite_score", "corridor_rank")


DISRUPTION_COLUMNS = ["obs_date", "year", "month", "tsi_freight", "tsi_freight_pct_change", "truck_vmt",
                      "rail_carloads", "petroleum_pipeline", "waterborne_freight", "inventory_to_sales_ratio",
                      "tsi_zscore", "vmt_zscore", "is_anomaly", "severity"]


def disruption_indicators(indicators: DataFrame, season: str = "month", include_baseline: bool = False,
                          baseline_method: str = "aggregate") -> DataFrame:
    """Seasonal z-scores of the freight index and truck mileage with flags.

    Flags compare the unrounded z; the output shows z rounded to 2 places.
    """
    b = seasonal_baseline(indicators, season, {"tsi_freight": "tsi", "truck_vmt": "vmt"}, method=baseline_method)
    z_tsi = zscore("tsi_freight", "tsi_mean", "tsi_stddev")
    z_vmt = zscore("truck_vmt", "vmt_mean", "vmt_stddev")
    flag, severity = flag_anomalies([z_tsi, z_vmt])
    out = b.select(
        *[c for c in ["obs_date", "year", "month"]],
        *([season] if season not in ("month", "year") else []),
        "tsi_freight", "tsi_freight_pct_change", "truck_vmt", "rail_carloads", "petroleum_pipeline",
        "waterborne_freight", "inventory_to_sales_ratio",
        F.round(z_tsi, 2).alias("tsi_zscore"), F.round(z_vmt, 2).alias("vmt_zscore"),
        flag.alias("is_anomaly"), severity.alias("severity"),
        *([F.col("tsi_mean"), F.col("tsi_stddev"), F.col("vmt_mean"), F.col("vmt_stddev")]
          if include_baseline else []),
    )
    return out
