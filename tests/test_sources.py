"""Sources and sinks: scan with contract (S1-S3), landing (S4), hashing and manifest
(S5, S6), counted write (S7), refresh (S8, T19), materialize (S10), gold layout (S12)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tradelanes.sources import files, manifest, schemas
from conftest import rows


@pytest.fixture
def trade(spark):
    cols = schemas.RAW_TRADE_COLUMNS
    data = []
    for m in (1, 2, 3):
        for i in range(4):
            vals = {c: None for c in cols}
            vals.update(trdtype="1", usastate=f"{i:02d}", commodity2="X", disagmot="5", country="1220",
                        value=str(10 * i + m), shipwt="1", month=str(m), year="2024")
            data.append(tuple(vals[c] for c in cols))
    return spark.createDataFrame(data, schemas.RAW_TRADE_SCHEMA)


def test_scan_binds_by_name_and_picks_members(spark, tmp_dir, trade):
    trade.write.option("header", True).csv(f"{tmp_dir}/a")
    trade.write.json(f"{tmp_dir}/b")
    back = files.read_landed_csv(spark, tmp_dir, schemas.RAW_TRADE_SCHEMA, glob="*.csv", recursive=True)
    assert rows(back) == rows(trade)


def test_scan_rejects_reordered_header(spark, tmp_dir, trade):
    trade.select(*reversed(trade.columns)).write.option("header", True).csv(f"{tmp_dir}/r")
    with pytest.raises(Exception):
        files.read_landed_csv(spark, f"{tmp_dir}/r", schemas.RAW_TRADE_SCHEMA).collect()


def test_contract_report(spark, tmp_dir, trade):
    trade.write.option("header", True).csv(f"{tmp_dir}/full")
    trade.drop("value", "year").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/short")
    rep = files.contract_report(spark, tmp_dir, schemas.REQUIRED_TRADE_COLUMNS, glob="*.csv")
    got = {(os.path.basename(os.path.dirname(r["file_path"])), r["missing_column"]) for r in rep.collect()}
    assert got == {("full", None), ("short", "VALUE"), ("short", "YEAR")}
    with pytest.raises(ValueError, match="VALUE"):
        files.require_columns(trade.drop("value"), schemas.REQUIRED_TRADE_COLUMNS)


def test_contract_report_of_awkward_headers(spark, tmp_dir):
    for name, text in (("empty", ""), ("upper", "TRDTYPE,VALUE\n1,2\n"), ("quoted", '"a, b","value",trdtype\n1,2,3\n'), ("bare", "value\n")):
        os.makedirs(f"{tmp_dir}/{name}")
        with open(f"{tmp_dir}/{name}/part-0.csv", "w") as f:
            f.write(text)
    rep = files.contract_report(spark, tmp_dir, ["trdtype", "value", "a, b"], glob="*.csv")
    got = {(os.path.basename(os.path.dirname(r["file_path"])), r["missing_column"]) for r in rep.collect()}
    assert got == {("empty", "trdtype"), ("empty", "value"), ("empty", "a, b"), ("upper", "a, b"), ("quoted", None),
                   ("bare", "trdtype"), ("bare", "a, b")}
    strict = files.contract_report(spark, f"{tmp_dir}/upper", ["trdtype"], glob="*.csv", case_sensitive=True)
    assert [r["missing_column"] for r in strict.collect()] == ["trdtype"]


def test_land_partitions(spark, tmp_dir, trade):
    files.land(trade, tmp_dir, "transborder")
    assert sorted(os.listdir(f"{tmp_dir}/source=transborder/year=2024")) == ["month=1", "month=2", "month=3"]


def test_refresh_replaces_only_present_months(spark, tmp_dir, trade):
    t = trade.select("usastate", F.col("value").cast("int").alias("v"), F.col("month").cast("int").alias("month"))
    files.refresh(t, tmp_dir, ("month",))
    files.refresh(t.where("month = 3").withColumn("v", F.lit(0)), tmp_dir, ("month",))
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 12
    assert {r["v"] for r in back.where("month = 3").collect()} == {0}
    assert back.where("month = 1").agg(F.sum("v")).first()[0] == 0 + 10 + 20 + 30 + 4
    files.refresh(t.where("month = 1"), tmp_dir)           # no partition columns: full replace
    assert spark.read.parquet(tmp_dir).count() == 4


def _record(source, path, sha, ts):
    return (source, "u", "f", path, ts, 1, sha, False, None, 0)


def test_changed_items_compare_with_the_newest_record(spark):
    recorded = spark.createDataFrame([
        _record("wide", "p", "A", "2024-01"), _record("wide", "p", "B", "2024-02"), _record("wide", "q", "C", "2024-01"),
        _record("monthly", "p", "A", "2024-01"), _record("wide", "r", None, "2024-01"), _record(None, "p", "N", "2024-01"),
    ], schemas.MANIFEST_SCHEMA)
    arrivals = spark.createDataFrame([
        ("wide", "p", "A"),  # came back after a change: changed
        ("wide", "q", "C"),  # as recorded
        ("monthly", "p", "A"), ("monthly", "new", "A"),  # as recorded, and a new item
        ("wide", "r", "D"), ("wide", "q", None),  # recorded without a hash, and arriving without one
        (None, "p", "N"),  # a null source is an item like any other
    ], "source string, path string, sha256 string")
    got = rows(manifest.changed_items(arrivals, recorded))
    assert sorted(got, key=str) == sorted([("wide", "p", "A"), ("monthly", "new", "A"), ("wide", "r", "D"), ("wide", "q", None)], key=str)
    assert rows(manifest.changed_items(arrivals.where("path = 'p' and source = 'wide'").withColumn("sha256", F.lit("B")), recorded)) == []


def test_ingest_keeps_items_without_a_hash(spark, tmp_dir):
    items = spark.createDataFrame([(1, "s", "A"), (2, "s", "A"), (3, "s", None), (4, "t", "A"), (5, None, "A")], "nr int, source string, sha256 string")
    items = items.select("*", F.lit("u").alias("source_url"), F.lit("f").alias("filename"), F.lit("p").alias("path"), F.lit(1).alias("row_count"))
    manifest.append_manifest(manifest.ingest(items, None, "nr"), f"{tmp_dir}/m")
    first = manifest.read_manifest(spark, f"{tmp_dir}/m")
    assert rows(first, "source", "sha256", "skipped", "reason") == [
        (None, "A", False, None), ("s", None, True, manifest.NO_HASH), ("s", "A", False, None), ("s", "A", True, None), ("t", "A", False, None)]
    again = manifest.ingest(items, first, "nr")
    assert {r.skipped for r in again.collect()} == {True} and again.columns == [f.name for f in schemas.MANIFEST_SCHEMA.fields]


def test_write_counted_and_materialize(spark, tmp_dir):
    df = spark.range(1234)
    assert files.write_counted(df, f"{tmp_dir}/c", "c") == 1234
    back = files.materialize(df.where("id % 2 = 0"), f"{tmp_dir}/m")
    assert back.count() == 617
    assert "Scan parquet" in back._jdf.queryExecution().executedPlan().toString()


def test_gold_layout_prunes(spark, tmp_dir):
    flows = spark.createDataFrame([(y, s, c, float(i)) for i, (y, s, c) in enumerate(
        (y, s, c) for y in (2020, 2021) for s in ("AK", "TX") for c in ("Bulk", "Food"))],
        "year int, origin_state string, commodity_category string, total_tons double")
    files.write_gold_flows(flows, tmp_dir)
    assert sorted(d for d in os.listdir(tmp_dir) if d.startswith("year=")) == ["year=2020", "year=2021"]
    q = spark.read.parquet(tmp_dir).where("year = 2021 and origin_state = 'TX'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(origin_state,TX)" in plan
    assert q.count() == 2


def test_load_dim_keeps_na_text(spark, tmp_dir):
    path = f"{tmp_dir}/dim_regions.csv"
    with open(path, "w") as f:
        f.write("region_code,region_name,state,region_type\n1,Alabama,NA,State\n11,Birmingham,AL,Metro\n"
                "12,,AL,Metro\n")
    schema = "region_code int, region_name string, state string, region_type string"
    dim = files.load_dim(spark, path, schema)
    got = rows(dim)
    assert got == [(1, "Alabama", "NA", "State"), (11, "Birmingham", "AL", "Metro"), (12, None, "AL", "Metro")]


def test_layout_skips_row_groups_for_each_filter(spark, tmp_dir):
    """Of the files of a year, a filter on the state alone or on the category alone can match few: by statistics, counted."""
    import glob

    import pyarrow.parquet as pq

    states, categories = [f"S{k:02d}" for k in range(16)], [f"C{k:02d}" for k in range(16)]
    flows = spark.createDataFrame([(2020, s, c, f"z{k % 40}", f"z{k % 30}", "n", "m", float(k)) for k, (s, c) in enumerate(
        (s, c) for s in states for c in categories for _ in range(8))],
        "year int, origin_state string, commodity_category string, origin_zone string, destination_zone string, origin_name string, commodity_name string, total_tons double")
    files.write_gold_flows(flows.repartition(4), tmp_dir, max_records_per_file=64)
    groups = [g for f in glob.glob(f"{tmp_dir}/year=2020/*.parquet") for m in [pq.read_metadata(f)] for g in map(m.row_group, range(m.num_row_groups))]

    def may_match(column, value):
        k = next(k for k in range(groups[0].num_columns) if groups[0].column(k).path_in_schema == column)
        return sum(g.column(k).statistics.min <= value <= g.column(k).statistics.max for g in groups)

    assert len(groups) >= 32
    assert all(may_match("origin_state", v) <= 0.45 * len(groups) for v in states)
    assert all(may_match("commodity_category", v) <= 0.45 * len(groups) for v in categories)
    back = spark.read.parquet(tmp_dir)
    assert sorted(map(tuple, back.select(*flows.columns).collect())) == sorted(map(tuple, flows.collect()))


def test_interleaved_key_of_nulls_and_one_value(spark):
    df = spark.createDataFrame([(None, 1), ("a", 1), ("b", 1), (None, 1)], "s string, one int")
    got = files.interleaved(df, ["s", "one"]).orderBy("_z").collect()
    assert [r.s for r in got] == ["a", "b", None, None] and files.interleaved(df.limit(0), ["s"]).count() == 0
