"""Physical plan shape of the headline marts: pruning, pushdown, exchanges."""

from __future__ import annotations

import __spark_entry__ as entry
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return _plan(df)


def test_lane_flows_prunes_columns_and_has_no_global_step(spark):
    df = entry.queries()["lane_flows"](spark, SF_SMALL)
    plan = _plan(df)
    # Only the six lineitem columns the mart needs are read.
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double," \
           "l_extendedprice:double,l_shipdate:timestamp_ntz>" in df._jdf.queryExecution().explainString(
               spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_mode_share_one_exchange_after_flows(spark):
    ms = entry.queries()["mode_share"](spark, SF_SMALL)
    plan = _plan(ms)
    # Above the lane-flow window, the corridor repartition serves the mode
    # aggregate, the share window and the previous-share window.
    top = plan.split("Window")[0]
    assert "SinglePartition" not in plan
    assert top.count("Exchange hashpartitioning(origin_zone") <= 1


def test_registered_queries_have_no_python_udfs(spark):
    qs = entry.queries()
    for key in ("lane_flows", "commodity_trends", "disruption_indicators", "silver_shipments", "unpivot_years",
                "percent_ranks_distributed", "quality_report"):
        plan = _plan(qs[key](spark, SF_SMALL))
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan, key
