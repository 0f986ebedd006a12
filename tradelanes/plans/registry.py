"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver tables (or frames Spark derives from them) in
full; limits appear only where a top-N is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelanes.functions.scalar import safe_ratio, surrogate_key
from tradelanes.operators.conform import conform, split_quarantine
from tradelanes.operators import mergeable, quality
from tradelanes.operators.keys import dedupe
from tradelanes.operators.reshape import pivot_values, unpivot_union
from tradelanes.operators.anomaly import seasonal_baseline
from tradelanes.operators.enrich import enrich_lanes, unmatched_keys, zone_key
from tradelanes.operators.measures import distinct_counts, rollup_measures, share_of_total
from tradelanes.operators.periods import latest, with_growth, with_previous
from tradelanes.operators.ranking import (
    composite_score,
    percent_ranks_distributed,
    rank_within_distributed,
    top_ranked,
)
from tradelanes.plans import analogue, chain, gold, serve, silver
from tradelanes.plans.inputs import Inputs
from tradelanes.plans.marts import mart
from tradelanes.session import scratch_path, stored
from tradelanes.sources import files, manifest, schemas, versions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Serving constants of the analogue (one origin "state" = region
# name, the cross-zone tonnage floor) and the region that J4 leaves out.
LEFT_OUT_REGION = 24
SERVE_STATE = "AMERICA"
SERVE_TONNAGE_FLOOR = 300


def register(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# ------------------------------------------------------------------ gold marts

@register("lane_flows")
def q_lane_flows(i: Inputs) -> DataFrame:
    """G1: lane flows with capped year-over-year growth."""
    return i.flows()


@register("commodity_trends")
def q_commodity_trends(i: Inputs) -> DataFrame:
    """Commodity trends with value per ton, rank and growth."""
    return gold.commodity_trends(i.flows())


@register("mode_share")
def q_mode_share(i: Inputs) -> DataFrame:
    """Mode share per corridor and year with decline flag."""
    return gold.mode_share(i.flows(), analogue.DECLINE_MODE_NAME)


@register("lane_scorecard")
def q_lane_scorecard(i: Inputs) -> DataFrame:
    """Top corridors of the latest year by composite percentile score."""
    return gold.lane_scorecard(i.flows())


@register("disruption_indicators")
def q_disruption(i: Inputs) -> DataFrame:
    """Seasonal z-scores, anomaly flag and severity."""
    return gold.disruption_indicators(i.indicators, season="hour_of_day")


# ------------------------------------------------------------------ joins

def _lane_totals(i: Inputs) -> DataFrame:
    return rollup_measures(i.shipments, gold.LANE_KEYS + ["year"],
                           {"total_tons": "tons", "total_value": "value", "total_tmiles": "tmiles"})


@register("enrich_lanes")
def q_enrich_lanes(i: Inputs) -> DataFrame:
    """Lane totals with role-playing region, commodity and mode attributes."""
    out = enrich_lanes(_lane_totals(i), i.regions, i.commodities, i.modes)
    return out.select(*[c for c in gold.LANE_FLOW_COLUMNS if c not in ("prev_year_tons", "yoy_growth_pct")])


@register("unmatched_keys")
def q_unmatched_keys(i: Inputs) -> DataFrame:
    """Zones of the fact without a region row, per role, with their row counts.

    All driver nations have a region, so the gap this is to find is made here: a dimension without one of them."""
    key, regions = zone_key("region_code"), i.regions.where(F.col("region_code") != LEFT_OUT_REGION)
    o = unmatched_keys(i.shipments, "origin_zone", regions, key, "zone").withColumn("role", F.lit("origin"))
    d = unmatched_keys(i.shipments, "destination_zone", regions, key, "zone").withColumn("role", F.lit("destination"))
    return o.unionByName(d).select("role", "zone", "fact_rows")


@register("share_of_total")
def q_share_of_total(i: Inputs) -> DataFrame:
    """Mode tonnage per corridor and year with the corridor total and share."""
    m = rollup_measures(i.shipments, ["origin_zone", "destination_zone", "mode_code", "year"], {"mode_tons": "tons"})
    return share_of_total(m, ["origin_zone", "destination_zone", "year"], "mode_tons", "corridor_total_tons",
                          "mode_share_pct").withColumn("corridor_total_tons",
                                                       F.col("corridor_total_tons").cast("decimal(38,2)"))


# ------------------------------------------------------------------ aggregates (A1-A5)

@register("sum_measures")
def q_sum_measures(i: Inputs) -> DataFrame:
    """A1: three measures summed per lane and year."""
    return _lane_totals(i)


@register("lane_diversity")
def q_lane_diversity(i: Inputs) -> DataFrame:
    """A2: distinct modes and commodities per corridor and year (pre-aggregated form)."""
    return distinct_counts(i.shipments, ["origin_zone", "destination_zone", "year"],
                           {"mode_count": "mode_code", "commodity_count": "commodity_code"})


@register("distinct_rollups")
def q_distinct_rollups(i: Inputs) -> DataFrame:
    """A2: distinct modes, commodities and (by sketch) destinations of corridor-years, corridors and origin states, all merged
    from one pass over the shipments."""
    sets = stored(mergeable.code_sets(i.shipments, ["origin_zone", "destination_zone", "year"], {
        "mode_count": ("mode_code", max(m for m, _, _ in analogue.MODE_SEED)),
        "commodity_count": ("commodity_code", max(c for _, c, _, _ in analogue.COMMODITY_SEED))}, {"destination_count": "destination_zone"}), "sets")
    states = i.regions.select(zone_key("region_code").alias("origin_zone"), F.col("state").alias("origin_state"))
    corridors = mergeable.merge_sets(sets, ["origin_zone", "destination_zone"])
    of_state = mergeable.merge_sets(sets.join(states, "origin_zone", "left"), ["origin_state"])
    out = None
    for level, merged in (("corridor_year", sets), ("corridor", corridors), ("state", of_state)):
        counts = mergeable.set_counts(merged).withColumn("level", F.lit(level))
        out = counts if out is None else out.unionByName(counts, allowMissingColumns=True)
    return out


@register("lane_summary")
def q_lane_summary(i: Inputs) -> DataFrame:
    """A1-A3: corridor summary: sums, distinct counts, average growth."""
    return gold.corridor_summary(i.flows())


@register("value_per_ton")
def q_value_per_ton(i: Inputs) -> DataFrame:
    """A5: value per ton per origin zone and commodity, zero-guarded."""
    g = rollup_measures(i.shipments, ["origin_zone", "commodity_code"], {"total_tons": "tons", "total_value": "value"})
    return g.withColumn("value_per_ton", safe_ratio("total_value", "total_tons", 4))


# ------------------------------------------------------------------ periods and windows

@register("latest_period")
def q_latest_period(i: Inputs) -> DataFrame:
    """P5: corridor summary rows of the newest year."""
    return latest(gold.corridor_summary(i.flows()), "year", mode="subquery")


@register("previous_period")
def q_previous_period(i: Inputs) -> DataFrame:
    """Previous row's tonnage per lane (may span a gap) and the strict year-1 variant."""
    t = with_previous(_lane_totals(i), "total_tons", gold.LANE_KEYS, "year", "prev_year_tons")
    t = with_previous(t, "total_tons", gold.LANE_KEYS, "year", "prev_year_tons_strict", strict_period=True)
    return t.drop("total_value", "total_tmiles")


@register("growth_pct")
def q_growth_pct(i: Inputs) -> DataFrame:
    """Uncapped growth percent per lane and year."""
    return with_growth(_lane_totals(i), "total_tons", gold.LANE_KEYS, capped=False).drop("total_value", "total_tmiles")


@register("capped_growth_pct")
def q_capped_growth(i: Inputs) -> DataFrame:
    """Growth capped to [-100, 1000], a missing base floors at -100."""
    return with_growth(_lane_totals(i), "total_tons", gold.LANE_KEYS, capped=True,
                       missing_base="floor").drop("total_value", "total_tmiles")


@register("capped_growth_pct_null")
def q_capped_growth_null(i: Inputs) -> DataFrame:
    """Growth capped to [-100, 1000], a missing base stays NULL."""
    return with_growth(_lane_totals(i), "total_tons", gold.LANE_KEYS, capped=True,
                       missing_base="null").drop("total_value", "total_tmiles")


def _corridor_years(i: Inputs) -> DataFrame:
    return rollup_measures(i.shipments, ["origin_zone", "destination_zone", "year"],
                           {"corridor_tons": "tons", "corridor_value": "value"})


@register("rank_within_year")
def q_rank_within_year(i: Inputs) -> DataFrame:
    """Rank of each corridor's tonnage within its year (descending), no year in one task."""
    return rank_within_distributed(_corridor_years(i), "year", "corridor_tons", "tonnage_rank")


PR_COLUMNS = {"volume_pct_rank": "total_tons", "value_pct_rank": "total_value",
              "growth_pct_rank": "avg_yoy_growth_pct", "diversity_pct_rank": "mode_count"}


def _summary_all_years(i: Inputs) -> DataFrame:
    # Growth with NULL for a missing base, so the average can be NULL (sorted last).
    return gold.corridor_summary(i.flows(missing_base="null")).drop("total_tmiles", "commodity_count")


@register("percent_ranks")
def q_percent_ranks(i: Inputs) -> DataFrame:
    """Percent ranks of four measures over all corridor-years; a test holds it against the global windows."""
    return percent_ranks_distributed(_summary_all_years(i), PR_COLUMNS)


@register("percent_ranks_distributed")
def q_percent_ranks_distributed(i: Inputs) -> DataFrame:
    """The same percent ranks without a single-partition window."""
    return percent_ranks_distributed(_summary_all_years(i), PR_COLUMNS)


@register("composite_score")
def q_composite_score(i: Inputs) -> DataFrame:
    """Weighted composite of the four percent ranks, rounded to 4."""
    r = percent_ranks_distributed(_summary_all_years(i), PR_COLUMNS)
    return composite_score(r, gold.SCORE_WEIGHTS, "composite_score", 4).select(
        "origin_zone", "destination_zone", "year", "composite_score")


@register("top_ranked")
def q_top_ranked(i: Inputs) -> DataFrame:
    """Corridor-years ranked by composite score, rank <= 25, ties kept."""
    r = percent_ranks_distributed(_summary_all_years(i), PR_COLUMNS)
    r = stored(composite_score(r, gold.SCORE_WEIGHTS, "composite_score", 4, raw_name="_raw"), "scored")
    return top_ranked(r, "_raw", gold.SCORECARD_TOP, "corridor_rank").select(
        "origin_zone", "destination_zone", "year", "composite_score", "corridor_rank")


@register("seasonal_baseline")
def q_seasonal_baseline(i: Inputs) -> DataFrame:
    """Per-season mean and sample stddev attached to every observation (rounded to 6)."""
    series = stored(i.indicators, "indicators")  # events are read and summed once
    b = seasonal_baseline(series, "hour_of_day", {"tsi_freight": "tsi", "truck_vmt": "vmt"})
    return b.select("obs_date", "hour_of_day", "tsi_freight", "truck_vmt",
                    *[F.round(c, 6).alias(c) for c in ("tsi_mean", "tsi_stddev", "vmt_mean", "vmt_stddev")])


@register("seasonal_baseline_by_day")
def q_seasonal_baseline_by_day(i: Inputs) -> DataFrame:
    """W8 kept up to date: moments of every day but the newest, then the newest day alone, merged to the statistics of each hour
    of the day."""
    base = scratch_path(i.spark, "baseline")
    series = i.indicators.withColumn("day", F.to_date("obs_date"))
    columns = {"tsi_freight": "tsi", "truck_vmt": "vmt"}
    newest = series.agg(F.max("day")).first()[0]
    mergeable.add_to_baseline(series.where(F.col("day") < F.lit(newest)), base, "hour_of_day", "day", columns)
    mergeable.add_to_baseline(series.where(F.col("day") == F.lit(newest)), base, "hour_of_day", "day", columns)
    merged = mergeable.baseline(versions.read(i.spark, base), "hour_of_day", "day")
    return merged.select("hour_of_day", *[F.round(c, 6).alias(c) for c in ("tsi_mean", "tsi_stddev", "vmt_mean", "vmt_stddev")])


@register("profile_by_month")
def q_profile_by_month(i: Inputs) -> DataFrame:
    """Q5/Q6: profiles of monthly trade kept for each month: all months but those of the newest year, then these alone, merged.
    The number of distinct values is a sketch's and shown where it is small (and exact)."""
    base, by = scratch_path(i.spark, "profiles"), ("year", "month")
    trade = stored(silver.silver_monthly_trade(i.raw_monthly_trade), "trade")
    newest = trade.agg(F.max("year")).first()[0]
    for rows in (trade.where(F.col("year") < F.lit(newest)), trade.where(F.col("year") == F.lit(newest))):
        mergeable.update_profile(rows, base, by, ["shipment_value", "ship_weight", "mode_code"], ["usa_state", "commodity_code", "mexico_state"])
    merged = mergeable.merged_profile(versions.read(i.spark, base), by)
    return merged.select("column_name", "n_rows", "n_nulls", "low", "high", F.round("mean", 2).alias("mean"), F.round("stddev", 2).alias("stddev"),
                         F.when(F.col("n_distinct") <= 50, F.col("n_distinct")).alias("few_distinct"))


@register("seasonal_zscores")
def q_seasonal_zscores(i: Inputs) -> DataFrame:
    """Z-scores of the two metrics against their season, rounded to 2."""
    d = gold.disruption_indicators(i.indicators, season="hour_of_day")
    return d.select("obs_date", "hour_of_day", "tsi_zscore", "vmt_zscore")


@register("anomaly_flags")
def q_anomaly_flags(i: Inputs) -> DataFrame:
    """Anomaly flag and severity per observation."""
    d = gold.disruption_indicators(i.indicators, season="hour_of_day")
    return d.select("obs_date", "is_anomaly", "severity")


@register("share_decline_flag")
def q_share_decline_flag(i: Inputs) -> DataFrame:
    """The decline flag with another category and threshold (HIGH, 3 points)."""
    m = gold.mode_share(i.flows(), "HIGH", points=3.0)
    return m.select("origin_zone", "destination_zone", "mode_code", "year", "mode_share_pct",
                    "prev_year_share_pct", F.col("truck_share_decline_flag").alias("decline_flag"))


# ------------------------------------------------------------------ silver, keys, reshape

@register("silver_shipments")
def q_silver_shipments(i: Inputs) -> DataFrame:
    """B1 (P1-P3, K1): typed wide shipments, validity filter, surrogate key."""
    return i.silver_shipments


@register("unpivot_years")
def q_unpivot_years(i: Inputs) -> DataFrame:
    """B2 (R1): one row per shipment and year from a single scan."""
    return silver.silver_shipments_long(i.silver_shipments, i.years)


@register("unpivot_union_check")
def q_unpivot_union_check(i: Inputs) -> DataFrame:
    """The union-of-projections spelling of the same unpivot."""
    ids = ["shipment_id"] + silver.SHIPMENT_KEY_COLUMNS
    return unpivot_union(i.silver_shipments, ids, silver.MEASURES, i.years)


@register("silver_monthly_trade")
def q_silver_monthly_trade(i: Inputs) -> DataFrame:
    """Typed monthly trade with surrogate key."""
    return silver.silver_monthly_trade(i.raw_monthly_trade)


@register("silver_indicators")
def q_silver_indicators(i: Inputs) -> DataFrame:
    """Typed indicator series parsed from text dates."""
    return i.indicators


@register("cast_quarantine")
def q_cast_quarantine(i: Inputs) -> DataFrame:
    """Rows whose text does not convert, with the offending columns."""
    typed = conform(i.raw_shipments(corrupt=True), silver.shipment_spec(i.years), on_error="quarantine")
    _, bad = split_quarantine(typed)
    return bad.select("origin_zone", "destination_zone", "mode_code", "commodity_code", "trade_type", "dist_band",
                      F.concat_ws(",", "_bad_columns").alias("bad_columns"))


@register("surrogate_key")
def q_surrogate_key(i: Inputs) -> DataFrame:
    """K1: md5 surrogate key over order columns (with NULLs and '-' in values), plain and length-prefixed."""
    o = i.table("orders")
    cols = [F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus"),
            F.nullif(F.col("o_orderstatus"), F.lit("F"))]
    return o.select("o_orderkey", surrogate_key(cols).alias("order_key"),
                    surrogate_key(cols, length_prefixed=True).alias("order_key_lp"))


@register("dedupe_keys")
def q_dedupe_keys(i: Inputs) -> DataFrame:
    """K2: one line item per (order, line number), earliest ship date first."""
    return dedupe(i.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("series_wide")
def q_series_wide(i: Inputs) -> DataFrame:
    """Tonnage per year with one column per commodity category."""
    t = gold.commodity_trends(i.flows())
    cats = sorted({c for _, _, _, c in analogue.COMMODITY_SEED})
    return pivot_values(t, ["year"], "commodity_category", "total_tons", cats, agg="sum",
                        names=[c.lower() for c in cats])


@register("scalar_catalog")
def q_scalar_catalog(i: Inputs) -> DataFrame:
    """Every scalar function of the models on the orders table."""
    o = i.table("orders")
    d = F.to_date(F.date_format("o_orderdate", "MM/dd/yyyy"), "MM/dd/yyyy")
    return o.select(
        "o_orderkey",
        F.round(F.col("o_totalprice").cast("decimal(18,2)"), 1).alias("price_r1"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status_or_null"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("F")), F.lit("none")).alias("status_filled"),
        F.least(F.greatest(F.col("o_totalprice"), F.lit(1000.0)), F.lit(300000.0)).alias("capped_price"),
        F.abs(F.col("o_totalprice") - F.lit(150000.0)).alias("price_gap"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("cust_code"),
        F.lpad(F.col("o_custkey").cast("string"), 2, "0").alias("cust_code_short"),
        F.concat(F.col("o_orderstatus"), F.lit(" → "), F.col("o_orderpriority")).alias("label"),
        d.alias("order_date"),
        F.year(d).alias("order_year"),
        F.month(d).alias("order_month"),
        F.make_date(F.year("o_orderdate"), F.lit(6), F.lit(15)).alias("mid_year"),
        F.md5("o_orderpriority").alias("priority_md5"),
        F.sha2(F.col("o_orderpriority"), 256).alias("priority_sha256"),
        (F.col("o_totalprice") * 2 - 1).alias("arith"),
        ((F.col("o_totalprice") > 200000) & F.col("o_orderstatus").isNotNull()).alias("is_big"),
    )


# ------------------------------------------------------------------ quality (Q1-Q7)

FLOW_NOT_NULL = ["origin_zone", "destination_zone", "commodity_code", "year", "total_tons", "origin_name",
                 "yoy_growth_pct"]


def _q_not_null(i: Inputs) -> DataFrame:
    return quality.not_null(i.flows(), FLOW_NOT_NULL, "lane_flows")


def _unique_rules(i: Inputs) -> list:
    return [quality.Unique(i.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"), quality.Unique(i.regions, ["region_code"], "regions"),
            quality.Unique(i.indicators, ["obs_date"], "silver_indicators")]


def _relationship_rules(i: Inputs) -> list:
    return [quality.Relationship(i.table("lineitem"), "l_partkey", i.table("part"), "p_partkey", "lineitem", "l_partkey"),
            quality.Relationship(i.table("orders"), "o_custkey", i.table("customer"), "c_custkey", "orders", "o_custkey"),
            quality.Relationship(i.shipments, "origin_zone", i.regions, zone_key("region_code"), "shipments", "origin_zone")]


def _q_unique(i: Inputs) -> DataFrame:
    return quality.keyed(_unique_rules(i))


def _q_accepted(i: Inputs) -> DataFrame:
    return quality.report([
        quality.accepted_values(i.table("lineitem"), "l_returnflag", ["A", "N", "R"], "lineitem"),
        quality.accepted_values(i.table("orders"), "o_orderstatus", ["F", "O"], "orders"),
        quality.accepted_values(gold.disruption_indicators(i.indicators, season="hour_of_day"), "severity",
                                ["NORMAL", "MEDIUM", "HIGH"], "disruption_indicators"),
    ])


def _q_relationships(i: Inputs) -> DataFrame:
    return quality.keyed(_relationship_rules(i))


def _q_ranges(i: Inputs) -> DataFrame:
    return quality.report([
        quality.ranges(i.table("lineitem"), [("l_quantity", 0, 50), ("l_discount", 0, 0.1), ("l_tax", 0, 0.05)],
                       "lineitem"),
        quality.ranges(i.table("events"), [("value", 0, None)], "events"),
    ])


def _q_variance(i: Inputs) -> DataFrame:
    return quality.report([
        quality.variance(i.indicators, ["tsi_freight", "truck_vmt", "rail_carloads"], "silver_indicators"),
        quality.variance(i.table("lineitem"), ["l_tax", "l_discount"], "lineitem"),
    ])


register("quality_not_null")(_q_not_null)
register("quality_unique")(_q_unique)
register("quality_accepted_values")(_q_accepted)
register("quality_relationships")(_q_relationships)
register("quality_ranges")(_q_ranges)
register("quality_variance")(_q_variance)


@register("quality_report")
def q_quality_report(i: Inputs) -> DataFrame:
    """Q7: every rule above in one report (the gate reads it).

    The single-pass rules of each table are grouped into one aggregate
    (``quality.profile``), so ``lineitem`` is scanned once for its accepted
    values, ranges and variance instead of once per rule, and the keys of all unique and
    relationship rules are counted in one pass (``quality.keyed``)."""
    lineitem = quality.profile(
        i.table("lineitem"), "lineitem", accepted=[("l_returnflag", ["A", "N", "R"])],
        bounds=[("l_quantity", 0, 50), ("l_discount", 0, 0.1), ("l_tax", 0, 0.05)], min_rows=1,
        variance=["l_tax", "l_discount"])
    indicators = quality.profile(i.indicators, "silver_indicators",
                                 variance=["tsi_freight", "truck_vmt", "rail_carloads"])
    return quality.report([
        _q_not_null(i),
        quality.keyed([*_unique_rules(i), *_relationship_rules(i)]),
        lineitem,
        quality.accepted_values(i.table("orders"), "o_orderstatus", ["F", "O"], "orders"),
        quality.accepted_values(gold.disruption_indicators(i.indicators, season="hour_of_day"), "severity",
                                ["NORMAL", "MEDIUM", "HIGH"], "disruption_indicators"),
        quality.ranges(i.table("events"), [("value", 0, None)], "events"),
        indicators,
    ])


# ------------------------------------------------------------------ sources and sinks
# Each writes to a fresh folder under the shared checkpoint directory and reads back.

@register("csv_roundtrip_scan")
def q_csv_roundtrip_scan(i: Inputs) -> DataFrame:
    """Land the monthly trade as CSV next to non-matching members, scan
    with the declared schema, a name pattern and recursive lookup."""
    base = scratch_path(i.spark, "landing")
    i.raw_monthly_trade.write.option("header", True).csv(f"{base}/transborder")
    i.raw_indicators.write.json(f"{base}/transborder_json")
    return files.read_landed_csv(i.spark, base, schemas.RAW_TRADE_SCHEMA, glob="*.csv", recursive=True)


@register("contract_report")
def q_contract_report(i: Inputs) -> DataFrame:
    """S3: required-column contracts of the three sources over every landed file: complete, missing a
    column, reordered, in upper case and empty files."""
    base = scratch_path(i.spark, "contract")
    raw = i.raw_monthly_trade
    raw.write.option("header", True).csv(f"{base}/trade_full")
    raw.drop("value").write.option("header", True).csv(f"{base}/trade_missing_value")
    raw.select(*reversed(raw.columns)).write.option("header", True).csv(f"{base}/trade_reordered")
    raw.select(*[F.col(c).alias(c.upper()) for c in raw.columns]).write.option("header", True).csv(f"{base}/trade_upper")
    raw.limit(0).drop(*raw.columns).select(F.lit("").alias("value")).write.text(f"{base}/trade_empty")
    i.raw_indicators.drop("vmt").write.option("header", True).csv(f"{base}/indicators_missing_vmt")
    i.raw_shipments().drop("sctg2").write.option("header", True).csv(f"{base}/shipments_missing_sctg2")
    found = None
    for source, required in (("trade", schemas.REQUIRED_TRADE_COLUMNS), ("indicators", schemas.REQUIRED_INDICATOR_COLUMNS),
                             ("shipments", schemas.required_shipment_columns(i.years))):
        report = files.contract_report(i.spark, f"{base}/{source}_*", required, glob="part-*")
        found = report if found is None else found.unionByName(report)
    return found.select(F.regexp_extract("file_path", r"/((?:trade|indicators|shipments)_[a-z0-9_]+)/", 1).alias("dataset"),
                        F.lower("missing_column").alias("missing_column")).distinct()


@register("landed_by_month")
def q_landed_by_month(i: Inputs) -> DataFrame:
    """Landing under source=/year=/month= and the row count per folder."""
    base = scratch_path(i.spark, "bronze")
    files.land(i.raw_monthly_trade, base, "transborder")
    back = i.spark.read.option("header", True).csv(base)
    return back.groupBy("source", "year", "month").agg(F.count(F.lit(1)).alias("rows"))


def _documents(i: Inputs) -> DataFrame:
    """Documents as arriving items: an item is a source and a slot, its versions the documents of that slot by id."""
    d = i.table("documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    slot = F.concat(F.lit("slot"), (F.col("n_chars") % 8).cast("string"))
    return d.select("doc_id", "source", "lang", manifest.content_hash("text").alias("sha256"),
                    F.size(F.split("text", "\n")).cast("long").alias("row_count"), slot.alias("slot"),
                    F.concat(F.lit("landing/"), "source", F.lit("/"), name).alias("source_url"), name.alias("filename"),
                    F.concat(F.lit("bronze/source="), "source", F.lit("/"), slot).alias("path"))


@register("changed_items")
def q_changed_items(i: Inputs) -> DataFrame:
    """Arriving documents whose content is not the newest recorded of their item.  Recorded are the English
    documents; everything arrives, so older recorded versions come back and count as changes."""
    d = _documents(i).select("doc_id", "source", "slot", "lang", "sha256")
    return manifest.changed_items(d.drop("lang"), d.where(F.col("lang") == "en"), ("source", "slot"), "doc_id")


@register("ingest_manifest")
def q_ingest_manifest(i: Inputs) -> DataFrame:
    """Two ingestion runs appended to the manifest, a snapshot between them: the English documents, then all documents, so
    contents come back after others (A, B, A).  Copies among the documents are equal content under several paths."""
    path, d = scratch_path(i.spark, "manifest"), _documents(i)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    manifest.ingest_run(d.where(english), path, "doc_id")
    manifest.compact(i.spark, path)
    manifest.ingest_run(d, path, "doc_id")
    return manifest.read_manifest(i.spark, path).drop("timestamp")


@register("load_row_counts")
def q_load_row_counts(i: Inputs) -> DataFrame:
    """Rows loaded per raw table, counted while writing (observation)."""
    base = scratch_path(i.spark, "raw")
    counts = [(name, files.write_counted(df, f"{base}/{name}", name)) for name, df in (
        ("raw_shipments", i.raw_shipments()), ("raw_monthly_trade", i.raw_monthly_trade),
        ("raw_indicators", i.raw_indicators))]
    return i.spark.createDataFrame(counts, "table_name string, row_count long")


@register("monthly_refresh")
def q_monthly_refresh(i: Inputs) -> DataFrame:
    """Full load, a reload of the newest year as the next version, in which every other month survives, and the old
    version dropped; read by version."""
    path = scratch_path(i.spark, "silver_trade")
    t = silver.silver_monthly_trade(i.raw_monthly_trade)
    versions.replace(t, path, ("year", "month"))
    newest = versions.replace(latest(t, "year"), path, ("year", "month"))
    versions.expire(i.spark, path, keep=1)
    return versions.read(i.spark, path, newest)


@register("gold_layout_read")
def q_gold_layout_read(i: Inputs) -> DataFrame:
    """Lane flows written with the read-optimised layout, then read
    with a year (partition) and state (row-group) filter."""
    return mart(i, "lane_flows").where((F.col("year") == latest_year(i)) & (F.col("origin_state") == SERVE_STATE)).select(*gold.LANE_FLOW_COLUMNS)


# ------------------------------------------------------------------ serving

def latest_year(i: Inputs) -> int | None:
    """The newest year of the stored mart: a partition column, so no data is read."""
    return mart(i, "lane_flows").agg(F.max("year")).first()[0]


@register("serve_category_series")
def q_serve_category_series(i: Inputs) -> DataFrame:
    """Tonnage per commodity category and year at mid-year."""
    return serve.category_series(mart(i, "commodity_trends"))


@register("serve_scorecard")
def q_serve_scorecard(i: Inputs) -> DataFrame:
    """The scorecard table with display scaling."""
    return serve.scorecard_table(mart(i, "lane_scorecard"))


@register("serve_mode_share_top")
def q_serve_mode_share_top(i: Inputs) -> DataFrame:
    """D3: mode share pivot of the 5 largest cross-zone corridors of the newest year of the stored mart."""
    return serve.mode_share_top(mart(i, "mode_share"), latest_year(i), SERVE_TONNAGE_FLOOR, [m for _, m, _ in analogue.MODE_SEED])


@register("serve_state_lanes")
def q_serve_state_lanes(i: Inputs) -> DataFrame:
    """Top 15 corridor x category flows from one origin state."""
    return serve.state_lanes(mart(i, "lane_flows"), latest_year(i), SERVE_STATE)


@register("serve_indicator_series")
def q_serve_indicator_series(i: Inputs) -> DataFrame:
    """Indicator series since a year, rescaled."""
    return serve.indicator_series(mart(i, "disruption_indicators"), 2024)


@register("serve_anomaly_events")
def q_serve_anomaly_events(i: Inputs) -> DataFrame:
    """Anomaly event annotations."""
    return serve.anomaly_events(mart(i, "disruption_indicators"))


@register("serve_growth_bands")
def q_serve_growth_bands(i: Inputs) -> DataFrame:
    """Growth banded into display classes."""
    return serve.growth_bands(mart(i, "lane_flows").select(*gold.LANE_KEYS, "year", "yoy_growth_pct"))


# ------------------------------------------------------------------ the chain of layers

@register("chain_lane_flows")
def q_chain_lane_flows(i: Inputs) -> DataFrame:
    """G1 at the end of the chain, and only what it needs: landed CSV -> B1 -> B2 -> G1, with contracts and gates between."""
    return chain.run(i, "lane_flows")["lane_flows"]


@register("chain_commodity_trends")
def q_chain_commodity_trends(i: Inputs) -> DataFrame:
    """G2 from the chain's stored G1."""
    return chain.run(i, "commodity_trends")["commodity_trends"]


@register("chain_monthly_trade")
def q_chain_monthly_trade(i: Inputs) -> DataFrame:
    """B3 landed by month, under its contract and its gate, a branch of the chain of its own."""
    return chain.run(i, "silver_monthly_trade")["silver_monthly_trade"]
