"""Latest period (P5), previous value (W1), growth from one lag (W2/W3), T5."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tradelanes.operators.periods import latest, with_growth, with_previous
from conftest import rows


@pytest.fixture
def series(spark):
    # Lane A has a gap (2019 missing); lane B has one year only.
    return spark.createDataFrame(
        [("A", 2017, Decimal("10.00")), ("A", 2018, Decimal("20.00")), ("A", 2020, Decimal("5.00")),
         ("B", 2020, Decimal("7.00"))],
        "lane string, year int, tons decimal(18,2)")


def test_lag_is_previous_row_not_previous_year(series):
    got = rows(with_previous(series, "tons", ["lane"], "year", "prev"), "lane", "year", "prev")
    assert got == [("A", 2017, None), ("A", 2018, Decimal("10.00")), ("A", 2020, Decimal("20.00")),
                   ("B", 2020, None)]


def test_strict_period_requires_year_minus_one(series):
    got = rows(with_previous(series, "tons", ["lane"], "year", "prev", strict_period=True), "lane", "year", "prev")
    assert got == [("A", 2017, None), ("A", 2018, Decimal("10.00")), ("A", 2020, None), ("B", 2020, None)]


def test_growth_from_single_lag(series):
    g = with_growth(series, "tons", ["lane"], "year", "prev", "g", capped=True)
    assert rows(g, "lane", "year", "g") == [("A", 2017, -100.0), ("A", 2018, 100.0), ("A", 2020, -75.0),
                                            ("B", 2020, -100.0)]
    u = with_growth(series, "tons", ["lane"], "year", "prev", "g", capped=False)
    assert rows(u, "lane", "year", "g") == [("A", 2017, None), ("A", 2018, 100.0), ("A", 2020, -75.0),
                                            ("B", 2020, None)]
    # One Window node for prev and growth.
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") <= 1


@pytest.mark.parametrize("mode", ["literal", "subquery"])
def test_latest(series, mode):
    assert rows(latest(series, "year", mode=mode), "lane", "year") == [("A", 2020), ("B", 2020)]


def test_latest_literal_reaches_scan(spark, tmp_dir, series):
    path = f"{tmp_dir}/s"
    series.write.partitionBy("year").parquet(path)
    df = latest(spark.read.parquet(path), "year", mode="literal")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 2020)" in plan


def test_latest_period_of_a_computed_frame_reads_it_once(spark, series):
    """Same rows in every mode; the stored one reads the newest period's folder and runs what is behind the frame once."""
    newest = sorted(r.asDict().items() for r in latest(series, "year").collect())
    for mode in ("subquery", "stored"):
        assert sorted(r.asDict().items() for r in latest(series, "year", mode).collect()) == newest
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(len(b))
            yield b

    got = latest(series.coalesce(1).mapInPandas(count, series.schema), "year", "stored")
    assert got.columns == series.columns and got.count() == 2
    assert runs.value == 4
    assert "PartitionFilters: [isnotnull(year" in got._jdf.queryExecution().toString()


def test_latest_period_of_an_empty_frame(series):
    for mode in ("literal", "subquery", "stored"):
        assert latest(series.limit(0), "year", mode).count() == 0
