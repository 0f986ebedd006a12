"""Gold marts on the smallest driver tables: output schemas (FIXTURES §1.6) and
properties (growth bounds, share sums, rank cut, flag domains)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL

CORRIDOR = ["origin_zone", "destination_zone", "origin_name", "destination_name", "origin_state",
            "destination_state"]


@pytest.fixture(scope="module")
def marts(spark):
    q = entry.queries()
    return {k: q[k](spark, SF_SMALL) for k in ("lane_flows", "commodity_trends", "mode_share", "lane_scorecard",
                                               "disruption_indicators")}


def test_output_columns(marts):
    assert marts["lane_flows"].columns == CORRIDOR + [
        "commodity_code", "commodity_name", "commodity_category", "mode_code", "mode_name", "mode_category",
        "year", "total_tons", "total_value", "total_tmiles", "prev_year_tons", "yoy_growth_pct"]
    assert marts["commodity_trends"].columns == [
        "commodity_code", "commodity_name", "commodity_category", "year", "total_tons", "total_value",
        "total_tmiles", "value_per_ton", "tonnage_rank", "prev_year_tons", "yoy_growth_pct"]
    assert marts["mode_share"].columns == CORRIDOR + [
        "mode_code", "mode_name", "mode_category", "year", "mode_tons", "corridor_total_tons", "mode_share_pct",
        "prev_year_share_pct", "truck_share_decline_flag"]
    assert marts["lane_scorecard"].columns == CORRIDOR + [
        "year", "total_tons", "total_value", "total_tmiles", "mode_count", "commodity_count",
        "avg_yoy_growth_pct", "volume_pct_rank", "value_pct_rank", "growth_pct_rank", "diversity_pct_rank",
        "composite_score", "corridor_rank"]
    d = marts["disruption_indicators"].columns
    assert [c for c in d if c != "hour_of_day"] == [
        "obs_date", "year", "month", "tsi_freight", "tsi_freight_pct_change", "truck_vmt", "rail_carloads",
        "petroleum_pipeline", "waterborne_freight", "inventory_to_sales_ratio", "tsi_zscore", "vmt_zscore",
        "is_anomaly", "severity"]


def test_lane_flows_growth_bounds_and_key(marts):
    f = marts["lane_flows"]
    r = f.agg(F.min("yoy_growth_pct").alias("lo"), F.max("yoy_growth_pct").alias("hi"),
              F.count(F.when(F.col("yoy_growth_pct").isNull(), 1)).alias("nulls"), F.count("*").alias("n")).first()
    assert r["lo"] >= -100 and r["hi"] <= 1000 and r["nulls"] == 0
    keys = ["origin_zone", "destination_zone", "commodity_code", "mode_code", "year"]
    assert f.select(*keys).distinct().count() == r["n"]


def test_mode_share_sums_to_100(marts):
    s = marts["mode_share"].groupBy("origin_zone", "destination_zone", "year").agg(
        F.sum("mode_share_pct").alias("s"), F.count("*").alias("modes"))
    bad = s.where(F.abs(F.col("s") - 100) > F.col("modes") * 0.005 + 1e-9).count()
    assert bad == 0
    assert marts["mode_share"].where(F.col("truck_share_decline_flag").isNull()).count() == 0


def test_scorecard_cut_and_ranges(marts):
    sc = marts["lane_scorecard"]
    rows = sc.collect()
    assert 0 < len(rows) and all(r["corridor_rank"] <= 25 for r in rows)
    assert all(r["origin_zone"] != r["destination_zone"] for r in rows)
    for c in ("volume_pct_rank", "value_pct_rank", "growth_pct_rank", "diversity_pct_rank"):
        assert all(0.0 <= r[c] <= 1.0 for r in rows)
    ranks = sorted(r["corridor_rank"] for r in rows)
    assert ranks[0] == 1
    assert len({r["year"] for r in rows}) == 1


def test_disruption_domains(marts):
    d = marts["disruption_indicators"]
    assert {r[0] for r in d.select("severity").distinct().collect()} <= {"NORMAL", "MEDIUM", "HIGH"}
    assert d.where(F.col("is_anomaly").isNull()).count() == 0
    # A flagged row has abs(z) above 2 in at least one (rounded) metric, up to rounding.
    assert d.where(F.col("is_anomaly") & (F.greatest(F.abs("tsi_zscore"), F.abs("vmt_zscore")) < 2.0)).count() == 0
