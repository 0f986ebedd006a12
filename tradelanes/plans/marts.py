"""The stored gold marts that the serving queries read.

One graph for each input folder, kept in the application's scratch folder: the first query builds the marts that it needs,
later ones find them up to date by the state of the input files and read them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from tradelanes.plans import analogue, gold
from tradelanes.plans.inputs import Inputs
from tradelanes.plans.nodes import Graph, Node, Source, files_state
from tradelanes.session import scratch_base, table_path
from tradelanes.sources import files


def _flows(shipments: DataFrame, regions: DataFrame, commodities: DataFrame, modes: DataFrame) -> DataFrame:
    return gold.lane_flows(shipments, regions, commodities, modes)


def _shares(flows: DataFrame) -> DataFrame:
    return gold.mode_share(flows, analogue.DECLINE_MODE_NAME)


def _disruption(indicators: DataFrame) -> DataFrame:
    return gold.disruption_indicators(indicators, season="hour_of_day")


def graph(i: Inputs) -> Graph:
    def source(name: str, load, *tables: str) -> Source:
        return Source(name, load, lambda: "|".join(files_state(i.spark, table_path(i.sf_dir, t)) for t in tables))

    base = f"{scratch_base(i.spark)}/marts-{hashlib.sha256(i.sf_dir.encode()).hexdigest()[:16]}"
    return Graph(i.spark, base, [
        source("shipments", lambda: i.shipments, "lineitem", "orders", "customer", "supplier", "part"),
        source("regions", lambda: i.regions, "nation", "region"),
        Source("commodities", lambda: i.commodities, lambda: repr(analogue.COMMODITY_SEED)),
        Source("modes", lambda: i.modes, lambda: repr(analogue.MODE_SEED)),
        source("indicators", lambda: i.indicators, "events"),
        Node("lane_flows", _flows, ["shipments", "regions", "commodities", "modes"], partition_cols=["year"], layout=files.gold_layout,
             options=tuple(files.GOLD_OPTIONS.items())),
        Node("commodity_trends", gold.commodity_trends, ["lane_flows"]),
        Node("mode_share", _shares, ["lane_flows"]),
        Node("lane_scorecard", gold.lane_scorecard, ["lane_flows"]),
        Node("disruption_indicators", _disruption, ["indicators"]),
    ])


def mart(i: Inputs, name: str) -> DataFrame:
    """A stored mart, up to date with the input files."""
    return graph(i).run(name)[name]
