"""Ranks (W4), percent ranks in both forms (W5), composite score (W6), top-N."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tradelanes.operators.ranking import (
    composite_score,
    percent_ranks,
    percent_ranks_distributed,
    rank_within,
    rank_within_distributed,
    top_ranked,
)
from tradelanes.plans.registry import QUERIES
from conftest import SF_SMALL, rows


def test_rank_nulls_first_when_descending(spark):
    df = spark.createDataFrame([(1, 2020, 5.0), (2, 2020, None), (3, 2020, 9.0), (4, 2020, 9.0), (5, 2021, 1.0)],
                               "id int, year int, v double")
    got = dict(rank_within(df, "year", "v", "r").select("id", "r").collect())
    # T4: the reference SQL engine puts NULLs first in a descending order; ties share a rank.
    assert got == {2: 1, 3: 2, 4: 2, 1: 4, 5: 1}
    asc = dict(rank_within(df, "year", "v", "r", descending=False).select("id", "r").collect())
    assert asc == {1: 1, 3: 2, 4: 2, 2: 4, 5: 1}


def _random_frame(spark, n, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        a = rnd.choice([None, None] + list(range(20)))            # many ties, NULLs
        b = rnd.random() if rnd.random() > 0.1 else None           # mostly distinct
        c = 7                                                      # one value for all rows
        data.append((i, a, b, c))
    return spark.createDataFrame(data, "id int, a int, b double, c int")


@pytest.mark.parametrize("n,seed", [(0, 0), (1, 1), (2, 2), (2000, 4)])
def test_distributed_percent_rank_equals_window(spark, n, seed):
    df = _random_frame(spark, n, seed)
    cols = {"pa": "a", "pb": "b", "pc": "c"}
    w = rows(percent_ranks(df, cols), "id", "pa", "pb", "pc")
    d = rows(percent_ranks_distributed(df, cols), "id", "pa", "pb", "pc")
    assert w == d
    assert all(0.0 <= x <= 1.0 for r in d for x in r[1:])


def test_distributed_percent_rank_has_no_single_partition_step_on_rows(spark):
    df = _random_frame(spark, 500, 9)
    plan = percent_ranks_distributed(df, {"pb": "b"})._jdf.queryExecution().executedPlan().toString()
    # No global (unpartitioned) window, and nothing in one task.
    assert "SinglePartition" not in plan


def test_composite_score_order_and_rounding(spark):
    df = spark.createDataFrame([(1, 1.0, 0.5, 0.25, 0.0)], "id int, a double, b double, c double, d double")
    s = composite_score(df, [("a", 0.35), ("b", 0.30), ("c", 0.25), ("d", 0.10)], "s", 4, raw_name="raw")
    r = s.first()
    assert r["s"] == round(0.35 * 1.0 + 0.30 * 0.5 + 0.25 * 0.25 + 0.10 * 0.0, 4)
    assert r["raw"] == 0.35 * 1.0 + 0.30 * 0.5 + 0.25 * 0.25 + 0.10 * 0.0


@pytest.mark.parametrize("distributed", [True, False])
def test_top_ranked_keeps_ties(spark, distributed):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([9, 8, 8, 8, 7, 6])], "id int, s double")
    got = rows(top_ranked(df, "s", 2, "r", distributed=distributed), "id", "r")
    # Rank <= 2 returns the leader and all three tied seconds.
    assert got == [(0, 1), (1, 2), (2, 2), (3, 2)]


@pytest.mark.parametrize("distributed", [True, False])
def test_top_ranked_fewer_rows_and_nulls(spark, distributed):
    df = spark.createDataFrame([(0, None), (1, 3.0), (2, 1.0)], "id int, s double")
    got = rows(top_ranked(df, "s", 5, "r", distributed=distributed), "id", "r")
    assert got == [(0, 1), (1, 2), (2, 3)]
    empty = df.where(F.lit(False))
    assert top_ranked(empty, "s", 5, "r", distributed=distributed).count() == 0


def test_distributed_percent_rank_fine_grid_and_hot_value(spark):
    rnd = random.Random(11)
    # A third of the rows share one value; a small per-range target forces the second, finer job.
    data = [(i, 5.0 if i % 3 == 0 else rnd.random() * 10, rnd.choice([None, 1.0, 2.0])) for i in range(1500)]
    df = spark.createDataFrame(data, "id int, a double, b double")
    cols = {"pa": "a", "pb": "b"}
    w = rows(percent_ranks(df, cols), "id", "pa", "pb")
    d = rows(percent_ranks_distributed(df, cols), "id", "pa", "pb")
    assert w == d


def test_top_ranked_many_ties_at_cut_has_no_window(spark):
    data = [(i, 10.0 if i < 3 else 5.0) for i in range(300)] + [(1000, None)]
    df = spark.createDataFrame(data, "id int, s double")
    top = top_ranked(df, "s", 5, "r")
    assert "Window" not in top._jdf.queryExecution().executedPlan().toString()
    got = rows(top, "r")
    # NULL first (rank 1), three 10.0 (rank 2), then 297 rows tied at 5.0 (rank 5).
    assert got == [(1,)] + [(2,)] * 3 + [(5,)] * 297
    assert rows(top_ranked(df, "s", 5, "r", distributed=False), "id", "r") == rows(top, "id", "r")


def test_rank_within_a_hot_period(spark):
    """Nine tenths of the rows in one period, ties, NULL values and a NULL period: the ranks of the window, over many tasks."""
    df = spark.range(4000).select(F.when(F.col("id") % 10 > 0, 2024).when(F.col("id") % 20 > 0, 2023).alias("year"),
                                  F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 501).cast("decimal(38,2)")).alias("v"), "id")
    for down in (True, False):
        got = rank_within_distributed(df.repartition(6), "year", "v", "r", descending=down)
        assert rows(got, "id", "year", "v", "r") == rows(rank_within(df, "year", "v", "r", descending=down), "id", "year", "v", "r")
    assert rank_within_distributed(df.limit(0), "year", "v").count() == 0


def test_registered_ranks_have_no_window_over_a_year(spark):
    plan = QUERIES["rank_within_year"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "row_number" not in line]
    assert windows and all("part" in line for line in windows) and "rank(" not in plan
