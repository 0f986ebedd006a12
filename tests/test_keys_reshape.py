"""Dedupe (K2), unpivot (R1) vs union (U1), pivots (R2, R3), sum-then-unpivot equivalence."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradelanes.operators.keys import dedupe, with_surrogate_key
from tradelanes.operators.measures import rollup_measures
from tradelanes.operators.reshape import conditional_pivot, pivot_values, unpivot_periods, unpivot_union
from conftest import rows

YEARS = [2017, 2018, 2019]


def test_dedupe_methods_agree_and_are_deterministic(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 20), rnd.randint(0, 2), rnd.choice([None, 1, 2]), rnd.random()) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, j int, o int, v double")
    a = dedupe(df, ["k", "j"], ["o"], method="aggregate")
    b = dedupe(df, ["k", "j"], ["o"], method="window")
    assert a.columns == df.columns
    assert rows(a) == rows(b)
    assert a.count() == df.select("k", "j").distinct().count()


def test_surrogate_key_column_first(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert with_surrogate_key(df, ["x", "y"], "id").columns == ["id", "x", "y"]


@pytest.fixture
def wide(spark):
    rnd = random.Random(5)
    data = []
    for i in range(50):
        vals = []
        for _m in ("tons", "value"):
            vals += [None if rnd.random() < 0.2 else Decimal(rnd.randint(0, 999)) for _ in YEARS]
        data.append((f"k{i % 7}", i, *vals))
    cols = ", ".join(f"{m}_{y} decimal(18,2)" for m in ("tons", "value") for y in YEARS)
    return spark.createDataFrame(data, f"grp string, id int, {cols}")


def test_unpivot_equals_union(wide):
    a = unpivot_periods(wide, ["grp", "id"], ["tons", "value"], YEARS)
    b = unpivot_union(wide, ["grp", "id"], ["tons", "value"], YEARS)
    assert a.columns == b.columns == ["grp", "id", "year", "tons", "value"]
    assert rows(a) == rows(b)
    assert a.count() == 50 * len(YEARS)
    assert "Exchange" not in a._jdf.queryExecution().executedPlan().toString()


def test_sum_then_unpivot_equals_unpivot_then_sum(wide):
    long_first = rollup_measures(unpivot_periods(wide, ["grp"], ["tons", "value"], YEARS), ["grp", "year"],
                                 {"tons": "tons", "value": "value"})
    sums = rollup_measures(wide, ["grp"], {f"{m}_{y}": f"{m}_{y}" for m in ("tons", "value") for y in YEARS})
    sum_first = unpivot_periods(sums, ["grp"], ["tons", "value"], YEARS)
    assert rows(long_first) == rows(sum_first)


def test_pivot_forms_agree(spark):
    df = spark.createDataFrame([("c1", "TRUCK", 60.0), ("c1", "RAIL", 40.0), ("c2", "TRUCK", 100.0)],
                               "c string, mode string, share double")
    p = pivot_values(df, ["c"], "mode", "share", ["TRUCK", "RAIL", "AIR"], names=["truck", "rail", "air"])
    q = conditional_pivot(df, ["c"], "mode", "share", [("TRUCK", "truck"), ("RAIL", "rail"), ("AIR", "air")])
    assert rows(p, "c", "truck", "rail", "air") == rows(q, "c", "truck", "rail", "air") == [
        ("c1", 60.0, 40.0, None), ("c2", 100.0, None, None)]
