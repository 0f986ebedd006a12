"""Typed projection, strict cast and quarantine (P1, P2), validity filter (P3); T15, T16, T18."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tradelanes.operators.conform import conform, split_quarantine, valid_rows
from conftest import rows

SPEC = [("a", "code", None), ("n", "count", "int"), ("x", "amount", "decimal(24,6)")]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([("k1", "1", "2.5"), ("k2", "x", "1"), ("k3", None, "oops"), ("", "3", None)],
                                 "a string, n string, x string")


def test_strict_cast_fails(raw):
    with pytest.raises(Exception, match=r"cannot cast column (count|amount) to"):
        conform(raw, SPEC, on_error="fail").collect()


def test_strict_cast_passes_clean_rows(raw):
    got = rows(conform(raw.where("a in ('k1', '')"), SPEC, on_error="fail"))
    assert got == [("", 3, None), ("k1", 1, Decimal("2.500000"))]


def test_quarantine_split(raw):
    clean, bad = split_quarantine(conform(raw, SPEC, on_error="quarantine"))
    assert rows(clean, "code") == [("",), ("k1",)]
    got = {r["code"]: list(r["_bad_columns"]) for r in bad.collect()}
    assert got == {"k2": ["count"], "k3": ["amount"]}


def test_null_mode(raw):
    got = rows(conform(raw, SPEC, on_error="null"), "code", "count")
    assert got == [("", 3), ("k1", 1), ("k2", None), ("k3", None)]


def test_valid_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 1.0), (None, 1.0), ("b", -1.0), ("c", None), ("d", 0.0)],
                               "z string, t double")
    assert rows(valid_rows(df, nonneg=["t"], nonempty=["z"]), "z") == [("a",), ("d",)]
