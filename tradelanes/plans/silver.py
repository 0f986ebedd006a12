"""Silver layer (B1-B4): conform, validate, key, unpivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelanes.operators.conform import conform, split_quarantine, valid_rows
from tradelanes.operators.keys import with_surrogate_key
from tradelanes.operators.reshape import unpivot_periods

NUMERIC = "decimal(24,6)"
MEASURES = ["tons", "value", "tmiles"]
SHIPMENT_KEY_COLUMNS = ["foreign_origin", "foreign_destination", "foreign_inmode", "foreign_outmode",
                        "origin_zone", "destination_zone", "mode_code", "commodity_code", "trade_type",
                        "dist_band"]


def shipment_spec(years: Sequence[int]):
    spec = [
        ("fr_orig", "foreign_origin", None), ("fr_dest", "foreign_destination", None),
        ("fr_inmode", "foreign_inmode", None), ("fr_outmode", "foreign_outmode", None),
        ("dms_orig", "origin_zone", None), ("dms_dest", "destination_zone", None),
        ("dms_mode", "mode_code", "int"), ("sctg2", "commodity_code", "int"),
        ("trade_type", "trade_type", "int"), ("dist_band", "dist_band", "int"),
    ]
    for m in MEASURES:
        spec += [(f"{m}_{y}", f"{m}_{y}", NUMERIC) for y in years]
    return spec


def silver_shipments(raw: DataFrame, years: Sequence[int], on_error: str = "fail") -> DataFrame:
    """B1: typed wide shipments with a surrogate key.

    Validity: first-year tonnage >= 0 (so NULL drops the row), zones and
    commodity present and non-empty; evaluated on the typed columns, the
    commodity check on its source text.  With ``on_error='quarantine'`` rows
    holding an unconvertible value are left out here (see ``cast_quarantine``).
    """
    typed = conform(raw, shipment_spec(years) + [("sctg2", "_sctg2_text", None)], on_error=on_error)
    if on_error == "quarantine":
        typed, _ = split_quarantine(typed)
    ok = valid_rows(typed, nonneg=[f"tons_{years[0]}"], nonempty=["origin_zone", "destination_zone", "_sctg2_text"])
    return with_surrogate_key(ok.drop("_sctg2_text"), SHIPMENT_KEY_COLUMNS, "shipment_id")


def silver_shipments_long(silver: DataFrame, years: Sequence[int]) -> DataFrame:
    """B2: one row per shipment and year (R1, one scan, no shuffle)."""
    ids = ["shipment_id"] + SHIPMENT_KEY_COLUMNS
    return unpivot_periods(silver, ids, MEASURES, years)


TRADE_SPEC = [
    ("trdtype", "trade_type", "int"), ("usastate", "usa_state", None), ("commodity2", "commodity_code", None),
    ("disagmot", "mode_code", "int"), ("mexstate", "mexico_state", None), ("canprov", "canada_province", None),
    ("country", "country_code", "int"), ("df", "domestic_foreign_flag", "int"), ("contcode", "container_code", None),
    ("value", "shipment_value", NUMERIC), ("shipwt", "ship_weight", NUMERIC),
    ("freight_charges", "freight_charges", NUMERIC), ("month", "month", "int"), ("year", "year", "int"),
]
TRADE_KEY_COLUMNS = ["trade_type", "usa_state", "commodity_code", "mode_code", "mexico_state", "canada_province",
                     "country_code", "domestic_foreign_flag", "container_code", "month", "year"]


def silver_monthly_trade(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """Typed monthly cross-border trade with a surrogate key."""
    typed = conform(raw, TRADE_SPEC, on_error=on_error)
    ok = valid_rows(typed, not_null=["shipment_value"], nonempty=["usa_state", "commodity_code"])
    return with_surrogate_key(ok, TRADE_KEY_COLUMNS, "transborder_id")


def indicator_spec(date_format: str):
    # Only the first len(date_format) characters are parsed, so a trailing time
    # part does not make the parse fail.
    obs = F.to_timestamp_ntz(F.substring("obs_date", 1, len(date_format)), F.lit(date_format))
    return [
        (obs, "obs_date", None),
        (F.year(obs), "year", None),
        (F.month(obs), "month", None),
        (F.hour(obs), "hour_of_day", None),
        ("tsi_freight", "tsi_freight", "double"),
        ("tsi_freight_c", "tsi_freight_pct_change", "double"),
        ("vmt", "truck_vmt", "double"),
        ("rail_frt_carloads", "rail_carloads", "double"),
        ("rail_frt_intermodal", "rail_intermodal", "double"),
        ("petroleum", "petroleum_pipeline", "double"),
        ("natural_gas", "natural_gas_pipeline", "double"),
        ("waterborne", "waterborne_freight", "double"),
        ("inv_to_sales", "inventory_to_sales_ratio", "double"),
        ("ind_pro", "industrial_production_index", "double"),
    ]


def silver_indicators(raw: DataFrame, date_format: str = "MM/dd/yyyy HH:mm", on_error: str = "fail") -> DataFrame:
    """Typed indicator series keyed by observation time."""
    typed = conform(raw, indicator_spec(date_format), on_error=on_error)
    return valid_rows(typed, not_null=["obs_date"])
