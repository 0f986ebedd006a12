"""Nothing of the inputs is left out, whatever years and nations they hold, and building a query reads no data."""

from __future__ import annotations

import shutil

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.oracle_check import compare, duck
from tradelanes import session
from tradelanes.plans.registry import QUERIES


@pytest.fixture(scope="module")
def shifted(spark, tmp_path_factory):
    """The smallest driver tables with all ship dates three years later."""
    base = tmp_path_factory.mktemp("shifted")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "events", "documents"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", base / f"{name}.parquet")
    later = F.expr("l_shipdate + interval 3 years").cast("timestamp_ntz")
    session.read_table(spark, SF_SMALL, "lineitem").withColumn("l_shipdate", later).write.parquet(str(base / "parts"))
    files = list((base / "parts").glob("part-*.parquet"))
    import pyarrow.parquet as pq
    pq.write_table(pq.read_table([str(f) for f in files]), base / "lineitem.parquet")
    return str(base)


def test_all_years_and_nations_count(spark, shifted):
    lines = session.read_table(spark, shifted, "lineitem").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)"))).first()[0]
    wide = QUERIES["silver_shipments"](spark, shifted)
    assert [c for c in wide.columns if c.startswith("tons_")] == [f"tons_{y}" for y in range(1998, 2005)]
    flows = QUERIES["lane_flows"](spark, shifted)
    assert flows.agg(F.sum("total_tons")).first()[0] == lines
    assert flows.where("origin_name is null or destination_state is null").count() == 0


@pytest.mark.parametrize("key", ["unpivot_years", "cast_quarantine", "serve_state_lanes"])
def test_shifted_years_match_the_sql(spark, shifted, key):
    con = duck(shifted)
    assert compare(spark, con, key, QUERIES[key], entry.oracle_sql()[key], shifted)["status"].startswith("OK")
    con.close()


def test_wide_sql_fails_on_years_it_has_no_columns_for(shifted):
    con = duck(shifted)
    with pytest.raises(Exception, match="other years"):
        con.execute(entry.oracle_sql()["silver_shipments"]).fetchall()
    con.close()


@pytest.mark.parametrize("key", ["lane_flows", "mode_share", "disruption_indicators", "quality_relationships", "quality_report", "latest_period", "changed_items"])
def test_building_a_query_starts_no_job(spark, key):
    spark.sparkContext.setJobGroup(f"plan-{key}", key)
    QUERIES[key](spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"plan-{key}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


class _Session:
    """A session without a checkpoint folder on a cluster."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_machine_local_fallback_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session)


def test_stored_tables_are_dropped(spark):
    kept = session.stored(spark.range(5), "five")
    assert kept.count() == 5 and "Scan parquet" in kept._jdf.queryExecution().executedPlan().toString()
    path = kept.inputFiles()[0]
    session.drop_scratch(spark)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))
