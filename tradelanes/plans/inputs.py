"""Lazily built inputs shared by the registered queries of one (spark, sf_dir)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tradelanes.plans import analogue, gold, silver


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._flows: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        from tradelanes.session import read_table
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def shipments(self) -> DataFrame:
        return analogue.shipment_lines(self.spark, self.sf_dir)

    @cached_property
    def years(self) -> list[int]:
        return analogue.shipment_years(self.spark, self.sf_dir)

    @cached_property
    def regions(self) -> DataFrame:
        return analogue.region_dim(self.spark, self.sf_dir)

    @cached_property
    def commodities(self) -> DataFrame:
        return analogue.commodity_dim(self.spark)

    @cached_property
    def modes(self) -> DataFrame:
        return analogue.mode_dim(self.spark)

    def flows(self, missing_base: str = "floor") -> DataFrame:
        if missing_base not in self._flows:
            self._flows[missing_base] = gold.lane_flows(self.shipments, self.regions, self.commodities, self.modes,
                                                        missing_base=missing_base)
        return self._flows[missing_base]

    @cached_property
    def raw_indicators(self) -> DataFrame:
        return analogue.raw_indicators(self.spark, self.sf_dir)

    @cached_property
    def indicators(self) -> DataFrame:
        return silver.silver_indicators(self.raw_indicators)

    def raw_shipments(self, corrupt: bool = False) -> DataFrame:
        return analogue.raw_shipments(self.spark, self.sf_dir, self.years, corrupt=corrupt)

    @cached_property
    def silver_shipments(self) -> DataFrame:
        return silver.silver_shipments(self.raw_shipments(), self.years)

    @cached_property
    def raw_monthly_trade(self) -> DataFrame:
        return analogue.raw_monthly_trade(self.spark, self.sf_dir)
