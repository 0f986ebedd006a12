"""Seasonal baseline (W8), z-scores (W9), flags (W10), decline flag (W11); T9-T13."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradelanes.operators.anomaly import flag_anomalies, seasonal_baseline, share_decline_flag, zscore
from tradelanes.plans import gold
from conftest import rows


@pytest.fixture
def obs(spark):
    data = [(s, i, float(i + s), 10.0) for s in range(3) for i in range(5)]   # metric b constant: zero variance
    data.append((3, 0, 1.0, 2.0))                                            # a season with one row
    return spark.createDataFrame(data, "season int, i int, a double, b double")


def test_baseline_aggregate_equals_window(obs):
    cols = {"a": "a", "b": "b"}
    agg = seasonal_baseline(obs, "season", cols, method="aggregate")
    win = seasonal_baseline(obs, "season", cols, method="window")
    pick = ["season", "i", "a_mean", "a_stddev", "b_mean", "b_stddev"]
    assert rows(agg, *pick) == rows(win, *pick)


def test_sample_stddev_and_single_row(obs):
    b = seasonal_baseline(obs, "season", {"a": "a"})
    got = {r["season"]: r["a_stddev"] for r in b.select("season", "a_stddev").distinct().collect()}
    assert got[0] == pytest.approx(1.5811388300841898)    # stddev_samp of 0..4
    assert got[3] is None                                 # T9: one row gives NULL


def test_zero_variance_gives_null_z_and_normal(obs):
    b = seasonal_baseline(obs, "season", {"a": "a", "b": "b"})
    z_a, z_b = zscore("a", "a_mean", "a_stddev"), zscore("b", "b_mean", "b_stddev")
    flag, sev = flag_anomalies([z_a, z_b], medium=1.2, high=1.5)
    out = b.select("season", "i", z_b.alias("zb"), flag.alias("f"), sev.alias("s"))
    assert all(r["zb"] is None for r in out.collect())    # T13
    # greatest() skips the NULL z, so severity still follows metric a.
    got = {(r["season"], r["i"]): (r["f"], r["s"]) for r in out.collect()}
    assert got[(0, 0)] == (True, "MEDIUM")               # z = -1.26
    assert got[(0, 2)] == (False, "NORMAL")
    assert got[(3, 0)] == (False, "NORMAL")               # both z NULL -> false, not NULL


def test_flags_compare_unrounded_z(spark):
    df = spark.createDataFrame([(2.004,), (3.0001,), (-3.5,), (None,)], "z double")
    flag, sev = flag_anomalies([F.col("z")])
    got = [(r[0], r[1]) for r in df.select(flag, sev).collect()]
    assert got == [(True, "MEDIUM"), (True, "HIGH"), (True, "HIGH"), (False, "NORMAL")]


def test_share_decline_flag(spark):
    df = spark.createDataFrame([("Truck", 50.0, 60.0), ("Truck", 56.0, 60.0), ("Rail", 10.0, 30.0),
                                ("Truck", 50.0, None)], "mode string, s double, p double")
    got = [r[0] for r in share_decline_flag(df, "mode", "Truck", "s", "p", 5.0, "f").select("f").collect()]
    assert got == [True, False, False, False]


def test_disruption_mart_columns(spark):
    ind = spark.createDataFrame(
        [(f"2020-{m:02d}-01", 2020, m, m, float(m), float(m * 2), 1.0, 1.0, 1.0, 1.0, 1.0)
         for m in range(1, 13)],
        "obs_date string, year int, month int, hour_of_day int, tsi_freight double, truck_vmt double, "
        "tsi_freight_pct_change double, rail_carloads double, petroleum_pipeline double, "
        "waterborne_freight double, inventory_to_sales_ratio double")
    d = gold.disruption_indicators(ind, season="year", include_baseline=True)
    assert d.columns[:14] == gold.DISRUPTION_COLUMNS
    assert {"tsi_mean", "tsi_stddev", "vmt_mean", "vmt_stddev"} <= set(d.columns)
    assert d.count() == 12
