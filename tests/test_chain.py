"""The chain of layers: stored tables, contracts and gates."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tradelanes.operators.quality import GateFailed
from tradelanes.plans import chain, nodes, silver
from tradelanes.plans.inputs import Inputs
from tradelanes.session import scratch_path
from tradelanes.sources import versions


def test_contract_and_gate_stop_the_chain(spark):
    class NoCommodity(Inputs):
        def raw_shipments(self, corrupt=False):
            return super().raw_shipments(corrupt).drop("sctg2")

    with pytest.raises(chain.ContractBroken, match="sctg2"):
        chain.run(NoCommodity(spark, SF_SMALL))

    class Twice(Inputs):
        def raw_shipments(self, corrupt=False):
            raw = super().raw_shipments(corrupt)
            return raw.unionByName(raw)

    with pytest.raises(GateFailed, match="shipment_id"):
        chain.run(Twice(spark, SF_SMALL))


def test_layers_read_stored_tables(spark):
    out = chain.run(Inputs(spark, SF_SMALL))
    assert list(out) == ["silver_shipments", "silver_shipments_long", "silver_monthly_trade", "silver_indicators", "lane_flows", "commodity_trends",
                         "mode_share", "lane_scorecard", "disruption_indicators"]
    for name, table in out.items():
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "lineitem" not in plan, name
    wide, long = out["silver_shipments"], out["silver_shipments_long"]
    assert long.count() == wide.count() * 7
    assert spark.table("lane_flows").count() == out["lane_flows"].count()


def test_only_what_is_out_of_date_is_rebuilt(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)

    def bring(*targets, **more):
        made = chain.graph(i, tmp_dir, **more)
        made.run(*targets)
        return made.written

    assert bring("silver_monthly_trade", "disruption_indicators") == ["silver_monthly_trade", "silver_indicators", "disruption_indicators"]  # ancestors only
    assert bring("silver_monthly_trade", "disruption_indicators") == []
    # One month comes again, with one row less
    month = i.raw_monthly_trade.where("year = 1996 and month = 3")
    again = month.subtract(month.limit(1)).withColumn("landed_year", F.col("year")).withColumn("landed_month", F.col("month"))
    (again.write.option("header", True).option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .partitionBy("landed_year", "landed_month").csv(f"{tmp_dir}/landing/trade"))
    assert bring("silver_monthly_trade", "disruption_indicators") == ["silver_monthly_trade"]  # its branch alone
    whole = silver.silver_monthly_trade(i.raw_monthly_trade).count()
    assert versions.read(spark, f"{tmp_dir}/tables/silver_monthly_trade").count() == whole - 1
    # A view is never written, and what reads it is up to date with it
    made = chain.graph(i, tmp_dir, views=["silver_indicators"])
    out = made.run("disruption_indicators")
    assert "silver_indicators" not in made.written and "Scan csv" in out["silver_indicators"]._jdf.queryExecution().executedPlan().toString()
    assert spark.sql("SELECT count(*) FROM silver_indicators").first()[0] == out["disruption_indicators"].count()


def test_graph_order_and_code(spark, tmp_dir):
    load = lambda: spark.range(3)
    built = []

    def double(df):
        built.append(1)
        return df.selectExpr("id * 2 AS id")

    def nodes_of(*parts):
        return nodes.Graph(spark, tmp_dir, parts)

    source = nodes.Source("s", load, lambda: "1")
    good = nodes_of(nodes.Node("b", double, ["a"]), nodes.Node("a", double, ["s"]), source, nodes.Node("other", double, ["s"]))
    assert good.order(["b"]) == ["s", "a", "b"]
    assert [r.id for r in good.run("b")["b"].orderBy("id").collect()] == [0, 4, 8] and built == [1, 1]
    with pytest.raises(ValueError, match="circle: a -> b -> a"):
        nodes_of(nodes.Node("a", double, ["b"]), nodes.Node("b", double, ["a"])).run("a")
    with pytest.raises(KeyError, match="a needs c"):
        nodes_of(nodes.Node("a", double, ["c"])).run("a")
    nodes_of(nodes.Node("a", double, ["s"], params=(2,)), source).run("a")
    assert len(built) == 3  # other parameters
    nodes_of(nodes.Node("a", double, ["s"], params=(2,)), nodes.Source("s", load, lambda: "2")).run("a")
    assert len(built) == 4  # other data
    nodes_of(nodes.Node("a", lambda df: df, ["s"], params=(2,)), nodes.Source("s", load, lambda: "2")).run("a")
    assert versions.versions(spark, f"{tmp_dir}/a") == [1, 2, 3, 4]  # other code


def test_gate_keeps_the_last_good_version(spark, tmp_dir):
    """A reload that fails its gate is not put in place: empty, out of range, and without variance."""
    i = Inputs(spark, SF_SMALL)
    chain.graph(i, tmp_dir).run("silver_indicators")
    before = versions.read(spark, f"{tmp_dir}/tables/silver_indicators").count()
    raw = i.raw_indicators
    for k, (bad, what) in enumerate(((raw.limit(0), "row_count"), (raw.withColumn("vmt", F.lit("7")), "variance"),
                                     (raw.unionAll(raw), "unique"), (raw.withColumn("tsi_freight", F.lit(None).cast("string")), "not_null"))):
        class Reload(Inputs):
            raw_indicators = bad

        made = chain.graph(Reload(spark, SF_SMALL), f"{tmp_dir}/bad{k}")
        made.base = f"{tmp_dir}/tables"
        with pytest.raises(GateFailed, match=what):
            made.run("silver_indicators")
        assert versions.versions(spark, f"{tmp_dir}/tables/silver_indicators") == [1]
    assert versions.read(spark, f"{tmp_dir}/tables/silver_indicators").count() == before > 0


def test_all_checks_of_the_models_run(spark):
    """39 columns without nulls, five unique keys and the accepted values of the models, besides the gates' own rules."""
    reports = []
    chain.graph(Inputs(spark, SF_SMALL), scratch_path(spark, "chain"), reports=reports).run()
    of = lambda rule: [r for r in reports if r.rule == rule]
    assert len(of("not_null")) == 39 and len(of("accepted_values")) == 1 and len(of("row_count")) == 9
    assert {"shipment_id", "transborder_id", "obs_date", "corridor_rank"} <= {r.column_name for r in of("unique")}
    assert len(of("relationships")) == 4 and len(of("variance")) == 2 and len(of("distinct_share")) == 2
    assert {(r.rule, r.table_name, r.column_name) for r in reports if not r.passed} <= chain.WARN_ONLY
