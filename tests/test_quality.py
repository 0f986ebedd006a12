"""Quality rules (Q1-Q6), report and gate (Q7)."""

from __future__ import annotations

import pytest

from tradelanes.operators import quality


@pytest.fixture
def t(spark):
    return spark.createDataFrame(
        [(1, "A", 1.0, 5.0), (2, "B", None, 5.0), (2, "Z", 3.0, 5.0), (None, None, 4.0, 5.0), (None, "A", -1.0, 5.0)],
        "k int, flag string, x double, c double")


def _by_column(rep):
    return {(r["rule"], r["column_name"]): (r["failures"], r["passed"]) for r in rep.collect()}


def test_rules(spark, t):
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    rep = quality.report([
        quality.not_null(t, ["k", "flag", "x"], "t"),
        quality.unique(t, ["k"], "t"),
        quality.accepted_values(t, "flag", ["A", "B"], "t"),
        quality.relationships(t, "k", parent, "k", "t", "k"),
        quality.ranges(t, [("x", 0, 3.5)], "t", min_rows=10),
        quality.variance(t, ["x", "c"], "t"),
    ])
    assert rep.columns == quality.REPORT_COLUMNS
    assert _by_column(rep) == {
        ("not_null", "k"): (2, False), ("not_null", "flag"): (1, False), ("not_null", "x"): (1, False),
        ("unique", "k"): (1, False),              # NULL keys are not duplicates
        ("accepted_values", "flag"): (1, False),   # NULL is not a violation
        ("relationships", "k"): (2, False),        # two rows carry k=2, no parent
        ("row_count", "*"): (5, False),            # shortfall against 10
        ("range", "x"): (2, False),                # -1 and 4
        ("variance", "x"): (0, True), ("variance", "c"): (1, False),   # T13: constant column
    }


def test_gate(spark, t):
    ok = quality.report([quality.accepted_values(t, "flag", ["A", "B", "Z"], "t")])
    assert quality.gate(ok) is True
    bad = quality.report([quality.unique(t, ["k"], "t")])
    assert quality.gate(bad, raise_on_failure=False) is False
    with pytest.raises(quality.GateFailed, match=r"unique\(t.k\): 1"):
        quality.gate(bad)


def test_profile_equals_separate_rules(spark, t):
    sep = quality.report([
        quality.not_null(t, ["k", "x"], "t"),
        quality.accepted_values(t, "flag", ["A", "B"], "t"),
        quality.ranges(t, [("x", 0, 3.5)], "t", min_rows=2),
        quality.variance(t, ["x", "c"], "t"),
    ])
    one = quality.profile(t, "t", not_null=["k", "x"], accepted=[("flag", ["A", "B"])], bounds=[("x", 0, 3.5)],
                          min_rows=2, variance=["x", "c"])
    # One aggregate: a single exchange (the separate rules plan one per rule).
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, sep.collect()))


def test_keyed_pass_equals_separate_rules(spark, t):
    parent = spark.createDataFrame([(1,), (3,), (3,)], "k int")
    empty = t.limit(0)
    two = spark.createDataFrame([("a:1", "b"), ("a", "1:b"), ("a:1", "b"), (None, "b"), (None, "b")], "x string, y string")
    one = quality.keyed([
        quality.Unique(t, ["k"], "t"), quality.Unique(two, ["x", "y"], "two"), quality.Unique(empty, ["k"], "empty"),
        quality.Relationship(t, "k", parent, "k", "t", "k"), quality.Relationship(empty, "k", parent, "k", "empty", "k"),
        quality.Relationship(t, "k", empty, "k", "t2", "k")])
    sep = quality.report([
        quality.unique(t, ["k"], "t"), quality.unique(two, ["x", "y"], "two"), quality.unique(empty, ["k"], "empty"),
        quality.relationships(t, "k", parent, "k", "t", "k"), quality.relationships(empty, "k", parent, "k", "empty", "k"),
        quality.relationships(t, "k", empty, "k", "t2", "k")])
    assert one.columns == quality.REPORT_COLUMNS
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 4
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, sep.collect()))


def test_distinct_share_and_empty_table(spark, t):
    many = spark.range(5000).selectExpr("id", "id % 10 AS few")
    rep = quality.profile(many, "m", distinct=[("id", 0.9), ("few", 0.9)])
    assert _by_column(rep) == {("distinct_share", "id"): (0, True), ("distinct_share", "few"): (1, False)}
    nothing = quality.profile(t.limit(0), "t", not_null=["k"], bounds=[("x", 0, 1)], min_rows=1, distinct=[("k", 0.5)])
    assert quality.gate(nothing, raise_on_failure=False) is False and _by_column(nothing)[("row_count", "*")] == (1, False)
    assert quality.gate(nothing, warn_only={("row_count", "t", "*")}) is True
