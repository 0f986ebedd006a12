"""The chain of layers: landed files -> silver -> gold, as nodes with their inputs, gates between them.

Sources are landed CSV files under column contracts.  A node is built, and its ancestors, only if its inputs or its code have
changed (``nodes``); what it has written is held against its rules and becomes the table's next version only if they
pass, so a later node never reads, and a reader never sees, a table that failed.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelanes.operators import quality
from tradelanes.operators.enrich import zone_key
from tradelanes.plans import analogue, gold, silver
from tradelanes.plans.inputs import Inputs
from tradelanes.plans.nodes import TABLE, VIEW, Graph, Node, Source, files_state
from tradelanes.session import scratch_path
from tradelanes.sources import files, schemas

#: Rules that may fail: the analogue has no tonnage in years without shipments, and corridors of one score share a rank.
WARN_ONLY = {("not_null", "silver_shipments_long", "tons"), ("not_null", "lane_flows", "total_tons"), ("not_null", "commodity_trends", "total_tons"),
             ("not_null", "mode_share", "mode_share_pct"), ("unique", "lane_scorecard", "corridor_rank")}


class ContractBroken(RuntimeError):
    """A landed file lacks a required column."""


def gated(name: str, not_null: Sequence[str], unique: Sequence[Sequence[str]] = (), accepted=(), bounds=(), variance=(), distinct=(),
          related: Sequence[tuple[str, int, object]] = (), reports: list | None = None) -> Callable[..., None]:
    """The check of a node: at least one row, no nulls, accepted values, ranges, columns that vary and differ (one aggregate);
    unique keys and keys that an input has (``related``: column, number of the input, its key; one pass for all)."""
    def check(built: DataFrame, *inputs: DataFrame) -> None:
        parts = [quality.profile(built, name, not_null=not_null, accepted=accepted, bounds=bounds, min_rows=1, variance=variance, distinct=distinct)]
        keys: list = [quality.Unique(built, k, name) for k in unique]
        keys += [quality.Relationship(built, c, inputs[nr], parent, name, c) for c, nr, parent in related]
        if keys:
            parts.append(quality.keyed(keys))
        found = quality.report(parts).collect()  # one row for each rule
        if reports is not None:
            reports.extend(found)
        quality.gate(built.sparkSession.createDataFrame(found, "rule string, table_name string, column_name string, failures long, passed boolean"),
                     warn_only=WARN_ONLY)

    return check


def _landed(i: Inputs, name: str, path: str, raw: Callable[[], DataFrame], schema, required: Sequence[str], by: Sequence[str] = ()) -> Source:
    """Raw text landed as CSV, by month if it has months, every file held against its contract, read with the declared schema."""
    def load() -> DataFrame:
        if not files.present(i.spark, path):
            rows = raw()
            for c in by:  # the files keep the columns that name their folder
                rows = rows.withColumn(f"landed_{c}", F.col(c))
            writer = rows.write.option("header", True)
            (writer.partitionBy(*[f"landed_{c}" for c in by]) if by else writer).csv(path)
        broken = files.contract_report(i.spark, path, required, glob="part-*").where("missing_column is not null").limit(20).collect()
        if broken:
            raise ContractBroken([r.asDict() for r in broken])
        return files.read_landed_csv(i.spark, path, schema, glob="part-*", recursive=True)

    return Source(f"landed_{name}", load, lambda: files_state(i.spark, path))


def _regions(i: Inputs, path: str) -> Source:
    """The region dimension as a seed file."""
    def load() -> DataFrame:
        if not files.present(i.spark, path):
            i.regions.write.option("header", True).csv(path)
        return files.load_dim(i.spark, path, "region_code int, region_name string, state string")

    return Source("seed_regions", load, lambda: files_state(i.spark, path))


def _flows(long: DataFrame, regions: DataFrame, commodities: DataFrame, modes: DataFrame) -> DataFrame:
    return gold.lane_flows(long, regions, commodities, modes)


def _shares(flows: DataFrame) -> DataFrame:
    return gold.mode_share(flows, analogue.DECLINE_MODE_NAME)


def _disruption(indicators: DataFrame) -> DataFrame:
    return gold.disruption_indicators(indicators, season="hour_of_day")


def graph(i: Inputs, base: str, views: Collection[str] = (), reports: list | None = None) -> Graph:
    """All sources and nodes over the folder ``base``; nodes in ``views`` are not written."""
    years = i.years
    landing = f"{base}/landing"

    def node(name: str, build, inputs: Sequence[str], params: tuple = (), **rules) -> Node:
        return Node(name, build, inputs, VIEW if name in views else TABLE, check=gated(name, reports=reports, **rules), params=params)

    return Graph(i.spark, f"{base}/tables", [
        _landed(i, "shipments", f"{landing}/shipments", i.raw_shipments, schemas.raw_shipments_schema(years), schemas.required_shipment_columns(years)),
        _landed(i, "trade", f"{landing}/trade", lambda: i.raw_monthly_trade, schemas.RAW_TRADE_SCHEMA, schemas.REQUIRED_TRADE_COLUMNS, by=("year", "month")),
        _landed(i, "indicators", f"{landing}/indicators", lambda: i.raw_indicators, schemas.RAW_INDICATOR_SCHEMA, schemas.REQUIRED_INDICATOR_COLUMNS),
        _regions(i, f"{landing}/seed_regions"),
        Source("seed_commodities", lambda: i.commodities, lambda: repr(analogue.COMMODITY_SEED)),
        Source("seed_modes", lambda: i.modes, lambda: repr(analogue.MODE_SEED)),
        node("silver_shipments", lambda raw: silver.silver_shipments(raw, years), ["landed_shipments"], (tuple(years),),
             not_null=["shipment_id", "origin_zone", "destination_zone", "commodity_code", "mode_code"], unique=[["shipment_id"]],
             bounds=[(f"tons_{y}", 0, None) for y in years], distinct=[("shipment_id", 0.9)]),
        node("silver_shipments_long", lambda wide: silver.silver_shipments_long(wide, years), ["silver_shipments"], (tuple(years),),
             not_null=["year", "tons", "shipment_id"], bounds=[("year", min(years, default=None), max(years, default=None)), ("tons", 0, None)]),
        node("silver_monthly_trade", silver.silver_monthly_trade, ["landed_trade"],
             not_null=["transborder_id", "usa_state", "commodity_code", "mode_code", "year", "month"], unique=[["transborder_id"]],
             bounds=[("month", 1, 12), ("shipment_value", 0, None)]),
        node("silver_indicators", silver.silver_indicators, ["landed_indicators"],
             not_null=["obs_date", "tsi_freight", "truck_vmt", "year"], unique=[["obs_date"]], bounds=[("month", 1, 12)],
             variance=["tsi_freight", "truck_vmt"], distinct=[("obs_date", 0.9)]),
        node("lane_flows", _flows, ["silver_shipments_long", "seed_regions", "seed_commodities", "seed_modes"],
             not_null=["origin_zone", "destination_zone", "commodity_code", "year", "total_tons"],
             unique=[["origin_zone", "destination_zone", "commodity_code", "mode_code", "year"]], bounds=[("yoy_growth_pct", -100, 1000)],
             related=[("origin_zone", 1, zone_key("region_code")), ("destination_zone", 1, zone_key("region_code")), ("commodity_code", 2, "commodity_code"),
                      ("mode_code", 3, "mode_code")]),
        node("commodity_trends", gold.commodity_trends, ["lane_flows"], not_null=["commodity_code", "year", "total_tons", "tonnage_rank"],
             unique=[["commodity_code", "year"]]),
        node("mode_share", _shares, ["lane_flows"], (analogue.DECLINE_MODE_NAME,), not_null=["origin_zone", "destination_zone", "mode_code", "year", "mode_share_pct"],
             bounds=[("mode_share_pct", 0, 100)]),
        node("lane_scorecard", gold.lane_scorecard, ["lane_flows"], not_null=["corridor_rank", "origin_zone", "destination_zone", "composite_score"],
             unique=[["corridor_rank"]], bounds=[("composite_score", 0, 1)]),
        node("disruption_indicators", _disruption, ["silver_indicators"], not_null=["obs_date", "tsi_freight", "severity"], unique=[["obs_date"]],
             accepted=[("severity", ["NORMAL", "MEDIUM", "HIGH"])]),
    ])


def run(i: Inputs, *targets: str, base: str | None = None, views: Collection[str] = ()) -> dict[str, DataFrame]:
    """Bring ``targets`` (default: all nodes) and what they need up to date; the nodes' frames by name, inputs first.
    Without ``base`` everything is built anew in a scratch folder."""
    made = graph(i, base or scratch_path(i.spark, "chain"), views)
    return {name: frame for name, frame in made.run(*targets).items() if isinstance(made.parts[name], Node)}
