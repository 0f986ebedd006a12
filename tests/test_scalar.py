"""Scalar expressions: growth policies (T1, T3), zero guards, surrogate key, bands."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradelanes.functions.scalar import (
    SURROGATE_NULL,
    band,
    capped_growth_pct,
    growth_pct,
    safe_ratio,
    surrogate_key,
)


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(
        [(1, Decimal("150.00"), Decimal("100.00")),   # +50
         (2, Decimal("5000.00"), Decimal("10.00")),   # +49900 -> capped 1000
         (3, Decimal("10.00"), None),                 # missing base
         (4, Decimal("10.00"), Decimal("0.00")),      # zero base
         (5, Decimal("0.00"), Decimal("10.00")),      # -100
         (6, Decimal("1.00"), Decimal("3.00"))],      # -66.666.. -> -66.67
        "id int, cur decimal(18,2), prev decimal(18,2)")


def test_capped_growth_floor_policy(pairs):
    got = dict(pairs.select("id", capped_growth_pct("cur", "prev").alias("g")).collect())
    # least/greatest skip NULLs, so a missing or zero base floors at -100.
    assert got == {1: 50.0, 2: 1000.0, 3: -100.0, 4: -100.0, 5: -100.0, 6: -66.67}


def test_capped_growth_null_policy(pairs):
    got = dict(pairs.select("id", capped_growth_pct("cur", "prev", missing_base="null").alias("g")).collect())
    assert got == {1: 50.0, 2: 1000.0, 3: None, 4: None, 5: -100.0, 6: -66.67}


def test_uncapped_growth_is_null_without_base(pairs):
    got = dict(pairs.select("id", growth_pct("cur", "prev").alias("g")).collect())
    assert got == {1: 50.0, 2: 49900.0, 3: None, 4: None, 5: -100.0, 6: -66.67}


def test_bad_policy_rejected():
    with pytest.raises(ValueError):
        capped_growth_pct("a", "b", missing_base="zero")


def test_safe_ratio_zero_guard(spark):
    df = spark.createDataFrame([(1, 10.0, 4.0), (2, 1.0, 0.0), (3, None, 2.0)], "id int, n double, d double")
    got = dict(df.select("id", safe_ratio("n", "d", 2, 100.0).alias("r")).collect())
    assert got == {1: 250.0, 2: None, 3: None}


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 2)).collect()] == [0.13, -0.13, 2.5]


def _py_key(parts, sep="-"):
    txt = sep.join(SURROGATE_NULL if p is None else str(p) for p in parts)
    return hashlib.md5(txt.encode()).hexdigest()


def test_surrogate_key_matches_macro_text(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "x-y")], "k int, a string, b string")
    got = dict(df.select("k", surrogate_key(["k", "a", "b"]).alias("h")).collect())
    assert got == {1: _py_key([1, "a", None]), 2: _py_key([2, None, "x-y"])}


def test_length_prefixed_key_avoids_separator_collision(spark):
    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c")], "x string, y string")
    plain = {r[0] for r in df.select(surrogate_key(["x", "y"])).collect()}
    lp = {r[0] for r in df.select(surrogate_key(["x", "y"], length_prefixed=True)).collect()}
    assert len(plain) == 1 and len(lp) == 2


def test_band(spark):
    df = spark.createDataFrame([(-10.0,), (0.0,), (3.0,), (7.0,), (None,)], "g double")
    got = [r[0] for r in df.select(band("g", [-5, 0, 5], ["down", "flat-", "flat+", "up"])).collect()]
    assert got == ["down", "flat+", "flat+", "up", None]
    with pytest.raises(ValueError):
        band("g", [1, 2], ["a", "b"])
