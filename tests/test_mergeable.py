"""Aggregates that merge: code sets (A2), seasonal moments (W8), profiles (Q5, Q6)."""

from __future__ import annotations

import os
import random
import statistics

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tradelanes.operators import mergeable, quality
from tradelanes.operators.anomaly import seasonal_baseline
from tradelanes.plans.registry import QUERIES
from tradelanes.sources import versions


def test_code_sets_merge_to_exact_counts(spark):
    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.choice("xyz"), rng.choice([None, 0, 63, 64, 127, 128, 199] + list(range(200))), rng.randrange(30)) for _ in range(900)]
    df = spark.createDataFrame(data + [("c", "x", None, None)], "k string, j string, code int, other int").repartition(4)
    sets = mergeable.code_sets(df, ["k", "j"], {"codes": ("code", 199)}, {"others": "other"})
    assert "Expand" not in sets._jdf.queryExecution().executedPlan().toString()
    for keys in (["k", "j"], ["k"], ["j"], []):
        got = mergeable.set_counts(mergeable.merge_sets(sets, keys))
        want = df.groupBy(*keys).agg(F.count_distinct("code").alias("codes"), F.count_distinct("other").alias("others"))
        assert rows(got, *keys, "codes", "others") == rows(want, *keys, "codes", "others")
    for bad in (-1, 200):
        with pytest.raises(Exception, match="code outside 0 to 199"):
            mergeable.code_sets(df.withColumn("code", F.lit(bad)), ["k"], {"codes": ("code", 199)}).collect()


def test_rollups_read_the_shipments_once(spark):
    plan = QUERIES["distinct_rollups"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "lineitem" not in plan and plan.count("/sets-") == 3


def test_baseline_takes_new_periods(spark, tmp_dir):
    rng = random.Random(1)
    data = [(m, s, rng.gauss(1e6, 3) if s else None) for m in range(1, 7) for s in (0, 1, 2, None) for _ in range(20)]
    df = spark.createDataFrame(data, "month int, season int, v double").repartition(3)
    mergeable.add_to_baseline(df.where("month < 6"), f"{tmp_dir}/a", "season", "month", {"v": "v"})
    before = set(os.listdir(f"{tmp_dir}/a/data"))
    mergeable.add_to_baseline(df.where("month = 6"), f"{tmp_dir}/a", "season", "month", {"v": "v"})
    added = set(os.listdir(f"{tmp_dir}/a/data")) - before
    assert len(added) == 1 and [d for d in os.listdir(f"{tmp_dir}/a/data/{added.pop()}") if "=" in d] == ["month=6"]
    mergeable.add_to_baseline(df.coalesce(1), f"{tmp_dir}/b", "season", "month", {"v": "v"})
    parts, whole = (mergeable.baseline(versions.read(spark, f"{tmp_dir}/{x}"), "season", "month") for x in "ab")
    got, all_at_once = ({r.season: (r.v_mean, r.v_stddev) for r in x.collect()} for x in (parts, whole))
    for s in (0, 1, 2, None):
        values = [v for _, t, v in data if t == s and v is not None]
        want = (statistics.fmean(values), statistics.stdev(values)) if values else (None, None)
        for x in (got[s], all_at_once[s]):
            assert x == want if want[0] is None else x == pytest.approx(want, rel=1e-7)


def test_null_season_has_statistics_in_both_forms(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "s int, v double")
    forms = [rows(seasonal_baseline(df, "s", {"v": "v"}, method=m), "s", "v", "v_mean", "v_stddev") for m in ("aggregate", "window")]
    assert forms[0] == forms[1] and forms[0][0][2] == 2.0


@pytest.fixture
def months(spark):
    return spark.createDataFrame([(m, float(k % 50 + m), "t%d" % (k % 7), None if k == 0 else k) for m in range(1, 5) for k in range(200)],
                                 "month int, v double, t string, k int")


def test_profile_of_parts_and_rules(spark, tmp_dir, months):
    mergeable.update_profile(months.where("month < 4"), tmp_dir, ["month"], ["v", "k"], ["t"])
    first = mergeable.merged_profile(versions.read(spark, tmp_dir), ["month"])
    mergeable.update_profile(months.where("month = 4"), tmp_dir, ["month"], ["v", "k"], ["t"])
    now = mergeable.merged_profile(versions.read(spark, tmp_dir), ["month"])
    got = {r.column_name: r for r in now.collect()}
    v = [r.v for r in months.collect()]
    assert (got["v"].n_rows, got["v"].n_nulls, got["k"].n_nulls, got["t"].n_distinct) == (800, 0, 4, 7)
    assert (got["v"].low, got["v"].high) == (min(v), max(v)) and got["v"].mean == pytest.approx(statistics.fmean(v))
    assert got["v"].stddev == pytest.approx(statistics.stdev(v)) and abs(got["v"].q50 - statistics.median(v)) <= 2
    assert got["t"].mean is None and got["t"].q50 is None

    def failed(profile, **rules):
        return {(r.rule, r.column_name) for r in mergeable.profile_report(profile, "m", **rules).collect() if not r.passed}

    assert failed(now, not_null=["v", "t"], bounds={"v": (1, 53)}, variance=["v"], distinct={"k": 0.2}, before=first, columns=["v", "k"]) == set()
    assert failed(now, min_rows=801, not_null=["k"], bounds={"v": (2, None), "k": (0, 100)}, distinct={"k": 0.5}) == {
        ("row_count", "*"), ("not_null", "k"), ("range", "v"), ("range", "k"), ("distinct_share", "k")}
    # The newest month comes again with other values, then empty of them
    mergeable.update_profile(months.where("month > 1").withColumn("v", F.lit(400.0)), tmp_dir, ["month"], ["v", "k"], ["t"])
    moved = mergeable.merged_profile(versions.read(spark, tmp_dir), ["month"])
    assert failed(moved, before=now, columns=["v", "k"]) == {("drift", "v")}
    nothing = mergeable.merged_profile(mergeable.profile_parts(months.limit(0), ["month"], ["v"]), ["month"])
    assert failed(nothing, not_null=["v"], variance=["v"]) == {("row_count", "*"), ("not_null", "v"), ("variance", "v")}
    with pytest.raises(quality.GateFailed):
        quality.gate(mergeable.profile_report(nothing, "m"))
