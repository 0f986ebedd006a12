"""Versioned tables (S8): atomic change, two writers, dead writers, expiry; the manifest on them."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradelanes.operators.ordered import previous_in_order
from tradelanes.sources import manifest, schemas, versions


@pytest.fixture
def months(spark):
    return spark.createDataFrame([(y, m, y * 100 + m + k) for y in (2023, 2024) for m in (1, 2, 3) for k in (0, 1)], "year int, month int, v int")


def test_partitions_of_a_version(spark, tmp_dir, months):
    assert versions.replace(months, tmp_dir, ("year", "month")) == 1
    new = months.where("year = 2024 and month = 2").withColumn("v", F.lit(-1))
    assert versions.replace(new, tmp_dir, ("year", "month")) == 2
    assert rows(versions.read(spark, tmp_dir, 1).select("year", "month", "v")) == rows(months)
    now = versions.read(spark, tmp_dir)
    assert now.count() == 12 and {r.v for r in now.where("year = 2024 and month = 2").collect()} == {-1}
    assert rows(now.where("month = 1").select("year", "month", "v")) == rows(months.where("month = 1"))
    plan = now.where("year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert now.schema["month"].dataType.simpleString() == "int" and versions.VERSION not in now.columns
    with pytest.raises(ValueError, match="partitioned by"):
        versions.replace(months, tmp_dir, ("year",))


def test_whole_table_and_null_partition(spark, tmp_dir, months):
    versions.replace(months.select("v"), tmp_dir)
    versions.replace(months.select("v").limit(0), tmp_dir)
    assert versions.read(spark, tmp_dir).count() == 0 and versions.read(spark, tmp_dir, 1).count() == 12
    odd = spark.createDataFrame([(None, 1), ("a/b", 2)], "p string, v int")
    versions.replace(odd, f"{tmp_dir}/odd", ("p",))
    assert rows(versions.read(spark, f"{tmp_dir}/odd"), "p", "v") == rows(odd, "p", "v")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, f"{tmp_dir}/none")


def test_dead_writer_leaves_the_table_readable(spark, tmp_dir, months):
    versions.replace(months, tmp_dir, ("year", "month"))

    @F.udf("int")
    def dies(v):
        if v == 202403:
            raise RuntimeError("killed")
        return v

    with pytest.raises(Exception, match="killed"):
        versions.replace(months.withColumn("v", dies("v")), tmp_dir, ("year", "month"))

    def refuse(written):
        assert written.count() == 12
        raise ValueError("gate")

    with pytest.raises(ValueError, match="gate"):
        versions.replace(months.withColumn("v", F.lit(0)), tmp_dir, ("year", "month"), check=refuse)
    assert versions.versions(spark, tmp_dir) == [1]
    assert rows(versions.read(spark, tmp_dir).select("year", "month", "v")) == rows(months)
    os.makedirs(f"{tmp_dir}/data/{versions.VERSION}=dead/_temporary")  # a failed job cleans up, a killed one does not
    assert len(os.listdir(f"{tmp_dir}/data")) == 3 and versions.read(spark, tmp_dir).count() == 12
    versions.expire(spark, tmp_dir)  # they may be at work yet
    assert len(os.listdir(f"{tmp_dir}/data")) == 3
    versions.expire(spark, tmp_dir, grace_hours=0)
    assert len(os.listdir(f"{tmp_dir}/data")) == 1 and versions.read(spark, tmp_dir).count() == 12


def test_of_two_writers_one_wins(spark, tmp_dir, months):
    versions.replace(months, tmp_dir, ("year", "month"))
    first = months.where("month = 1").withColumn("v", F.lit(1))
    versions.replace(first, tmp_dir, ("year", "month"), based_on=1)
    with pytest.raises(versions.CommitConflict, match="version 2"):
        versions.replace(first.withColumn("v", F.lit(2)), tmp_dir, ("year", "month"), based_on=1)
    assert versions.versions(spark, tmp_dir) == [1, 2]
    assert {r.v for r in versions.read(spark, tmp_dir).where("month = 1").collect()} == {1}
    assert not [f for f in os.listdir(f"{tmp_dir}/commits") if f.startswith(".draft")]


def test_old_versions_expire(spark, tmp_dir, months):
    for k in range(4):
        versions.replace(months.where("month = 1" if k else "true").withColumn("v", F.lit(k)), tmp_dir, ("year", "month"))
    assert versions.expire(spark, tmp_dir, keep=2) == [1, 2]
    assert versions.versions(spark, tmp_dir) == [3, 4]
    for version in (3, 4):
        got = versions.read(spark, tmp_dir, version)
        assert got.count() == 12 and {r.v for r in got.where("month = 1").collect()} == {version - 1}
    assert versions.expire(spark, tmp_dir, keep=1) == [3] and versions.read(spark, tmp_dir).count() == 12


def item(nr, path, sha, source="s"):
    return (nr, source, path, sha, "u", "f", 1)


ITEMS = "nr long, source string, path string, sha256 string, source_url string, filename string, row_count long"


def test_manifest_and_change_detection_agree(spark, tmp_dir):
    """A, B, A within a run and over runs, equal content under two paths, items without a hash, null names."""
    runs = [
        [item(1, "p", "A"), item(2, "p", "B"), item(3, "p", "A"), item(4, "q", "A"), item(5, "p", None), item(6, "p", "A"), item(7, None, "A", None)],
        [item(1, "p", "A"), item(2, "p", "B"), item(3, "r", "C"), item(4, None, "A", None)],
        [item(1, "p", "A"), item(2, "q", "A"), item(3, "r", "C"), item(4, "r", "C")],
    ]
    want = [[False, False, False, False, True, True, False], [True, False, False, True], [False, True, True, True]]
    for k, (run, skipped) in enumerate(zip(runs, want), 1):
        batch = spark.createDataFrame(run, ITEMS)
        first = batch.dropDuplicates(["source", "path"])
        changed = {(r.source, r.path, r.sha256) for r in manifest.changed_items(
            first, manifest.read_manifest(spark, tmp_dir), version=("run", "arrival")).collect()}
        assert manifest.ingest_run(batch, tmp_dir, "nr") == k
        got = manifest.read_manifest(spark, tmp_dir, k - 1)
        assert [r.skipped for r in got.orderBy("arrival").collect()] == skipped
        for r in first.collect():  # both say the same of an item's first arrival
            assert ((r.source, r.path, r.sha256) in changed) == (not skipped[r.nr - 1])
        if k == 1:
            assert manifest.compact(spark, tmp_dir) == 1
    assert manifest.read_manifest(spark, tmp_dir).count() == 15
    assert rows(manifest.newest_known(spark, tmp_dir)) == [(None, None, "A"), ("s", "p", "A"), ("s", "q", "A"), ("s", "r", "C")]


def test_snapshot_spares_the_history(spark, tmp_dir):
    batch = spark.createDataFrame([item(1, "p", "A")], ITEMS)
    for _ in range(3):
        manifest.ingest_run(batch, tmp_dir, "nr")
    before = manifest.newest_known(spark, tmp_dir).inputFiles()
    manifest.compact(spark, tmp_dir)
    after = manifest.newest_known(spark, tmp_dir).inputFiles()
    assert sum("run=" in f for f in before) == 3 and after and not any("run=" in f for f in after)
    manifest.ingest_run(batch, tmp_dir, "nr")
    assert [f for f in manifest.newest_known(spark, tmp_dir).inputFiles() if "run=4" in f] and manifest.read_manifest(spark, tmp_dir).count() == 4
    assert {f.name for f in schemas.MANIFEST_SCHEMA.fields} < set(manifest.read_manifest(spark, tmp_dir).columns)


def test_appends_of_two_writers_both_stay(spark, tmp_dir, monkeypatch):
    df, known = spark.range(3), versions.commit
    versions.append(df, tmp_dir, "run")

    def once(session, base, version=None):
        monkeypatch.setattr(versions, "commit", known)
        found = known(session, base, version)
        versions.append(df, base, "run")  # another writer comes in between
        return found

    monkeypatch.setattr(versions, "commit", once)
    assert versions.append(df, tmp_dir, "run") == 3
    got = versions.read(spark, tmp_dir).groupBy("run").count().collect()
    assert sorted(map(tuple, got)) == [(1, 3), (2, 3), (3, 3)]


def test_previous_value_over_ranges(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").alias("g"), "id", (F.col("id") * 7 % 11).alias("v"))
    got = {r.id: r.p for r in previous_in_order(df.repartition(5), ["g"], "id", "v", "p").collect()}
    last = {}
    for i in range(2000):
        g = i % 3 > 0
        assert got[i] == last.get(g)
        last[g] = i * 7 % 11
