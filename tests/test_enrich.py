"""Dimension joins (J1-J4): padded key, role-playing dimension, unmatched keys; T7, T8."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradelanes.operators.enrich import enrich_lanes, unmatched_keys, zone_key
from conftest import rows


def test_zone_key_pads_and_truncates(spark):
    df = spark.createDataFrame([(7,), (123,), (1234,)], "c int")
    assert [r[0] for r in df.select(zone_key("c")).collect()] == ["007", "123", "123"]


def test_enrich_lanes_roles_and_unmatched(spark):
    regions = spark.createDataFrame([(1, "One", "S1"), (20, "Twenty", "NA")],
                                    "region_code int, region_name string, state string")
    coms = spark.createDataFrame([(5, "Five", "Cat")], "commodity_code int, commodity_name string, "
                                                        "commodity_category string")
    modes = spark.createDataFrame([(1, "Truck", "Road")], "mode_code int, mode_name string, mode_category string")
    lanes = spark.createDataFrame([("001", "020", 5, 1, 10), ("001", "099", 6, 2, 1)],
                                  "origin_zone string, destination_zone string, commodity_code int, mode_code int, n int")
    out = enrich_lanes(lanes, regions, coms, modes)
    got = rows(out, "destination_zone", "origin_name", "destination_name", "destination_state", "commodity_name",
               "mode_name")
    # T25: 'NA' is text, not NULL; unmatched keys keep their row with NULL attributes.
    assert got == [("020", "One", "Twenty", "NA", "Five", "Truck"), ("099", "One", None, None, None, None)]
    miss = unmatched_keys(lanes, "destination_zone", regions, zone_key("region_code"), "zone")
    assert rows(miss) == [("099", 1)]
