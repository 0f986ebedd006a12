"""Dimension joins.

Plain equi joins: which side is broadcast is left to the optimizer, which knows
the sizes in bytes (of files when planning, of shuffled data when running).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.functions.scalar import col_of

def zone_key(code: str | Column, width: int = 3, pad: str = "0") -> Column:
    """Text zone key from an integer region code: ``lpad(cast(code as string), 3, '0')``.

    ``lpad`` also truncates values longer than ``width``, as in the SQL it mirrors.
    """
    return F.lpad(col_of(code).cast("string"), width, pad)


def role_dimension(dim: DataFrame, key: Column, key_name: str, columns: Mapping[str, str]) -> DataFrame:
    """One role of a role-playing dimension: the key plus renamed attributes."""
    return dim.select(key.alias(key_name), *[F.col(src).alias(dst) for src, dst in columns.items()])


def enrich(fact: DataFrame, dim: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Equi join of ``fact`` to ``dim`` on the shared column ``on``."""
    return fact.join(dim, on=on, how=how)


def enrich_lanes(
    lanes: DataFrame,
    regions: DataFrame,
    commodities: DataFrame,
    modes: DataFrame,
    region_code: str = "region_code",
) -> DataFrame:
    """Attach origin/destination region, commodity and mode attributes.

    The region dimension plays two roles (J2); its integer code is padded once
    on the dimension side to match the text zone of the fact (J1).
    """
    key = zone_key(region_code)
    origin = role_dimension(regions, key, "origin_zone",
                            {"region_name": "origin_name", "state": "origin_state"})
    dest = role_dimension(regions, key, "destination_zone",
                          {"region_name": "destination_name", "state": "destination_state"})
    out = enrich(enrich(lanes, origin, "origin_zone"), dest, "destination_zone")
    return enrich(enrich(out, commodities, "commodity_code"), modes, "mode_code")


def unmatched_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: Column | str,
                   name: str = "key") -> DataFrame:
    """Fact keys without a dimension row, with the number of fact rows carrying each.

    The count is a partial aggregate, so a hot key is combined map-side before
    the shuffle; the anti join then runs on distinct keys only.
    """
    counts = fact.groupBy(F.col(fact_key).alias(name)).agg(F.count(F.lit(1)).alias("fact_rows"))
    keys = dim.select(col_of(dim_key).alias(name)).where(F.col(name).isNotNull())
    return counts.join(keys, on=name, how="left_anti")
