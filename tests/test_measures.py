"""Sums (A1), distinct counts (A2), exact average (A3), share of total."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradelanes.operators.measures import distinct_counts, exact_avg, rollup_measures, share_of_total
from conftest import rows


@pytest.fixture
def facts(spark):
    rnd = random.Random(7)
    data = []
    for i in range(600):
        # Corridor ("o0", "d0") is hot: a third of all rows.
        o, d = ("o0", "d0") if i % 3 == 0 else (f"o{rnd.randint(0, 3)}", f"d{rnd.randint(0, 3)}")
        data.append((o, d, rnd.randint(1, 4), rnd.choice([None, 1, 2, 3]), 2000 + rnd.randint(0, 2),
                     Decimal(rnd.randint(0, 10_000)) / 100))
    return spark.createDataFrame(data, "o string, d string, mode int, com int, year int, tons decimal(18,2)")


def test_rollup_sums_exact(facts):
    g = rollup_measures(facts, ["o", "d", "year"], {"t": "tons"})
    assert g.schema["t"].dataType.simpleString() == "decimal(38,2)"
    total = sum(r["t"] for r in g.collect())
    assert total == sum(r["tons"] for r in facts.collect())


def test_distinct_counts_pre_aggregate_equals_count_distinct(facts):
    cols = {"modes": "mode", "coms": "com"}
    a = distinct_counts(facts, ["o", "d", "year"], cols, pre_aggregate=True)
    b = distinct_counts(facts, ["o", "d", "year"], cols, pre_aggregate=False)
    assert rows(a, "o", "d", "year", "modes", "coms") == rows(b, "o", "d", "year", "modes", "coms")
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1.005), (1, None), (1, 2.0), (2, None)], "g int, x double")
    got = dict(df.groupBy("g").agg(exact_avg("x").alias("a")).collect())
    assert got[1] == pytest.approx(1.505) and got[2] is None


def test_share_window_equals_join_back(facts):
    m = rollup_measures(facts, ["o", "d", "mode", "year"], {"mt": "tons"})
    w = share_of_total(m, ["o", "d", "year"], "mt", "total", "share")
    tot = m.groupBy("o", "d", "year").agg(F.sum("mt").alias("total"))
    j = m.join(tot, ["o", "d", "year"]).withColumn(
        "share", F.round(F.col("mt").cast("double") / F.nullif(F.col("total").cast("double"), F.lit(0.0)) * 100, 2))
    pick = ["o", "d", "mode", "year", "total", "share"]
    assert rows(w, *pick) == rows(j, *pick)


def test_shares_sum_to_100(facts):
    m = rollup_measures(facts, ["o", "d", "mode", "year"], {"mt": "tons"})
    w = share_of_total(m, ["o", "d", "year"], "mt", "total", "share").where(F.col("total") > 0)
    sums = w.groupBy("o", "d", "year").agg(F.sum("share").alias("s")).collect()
    assert sums and all(abs(r["s"] - 100.0) <= 0.01 * 4 for r in sums)
