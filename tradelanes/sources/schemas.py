"""Declared schemas: raw (bronze) tables are all text, as landed; the
manifest has typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def raw_shipments_schema(years: Sequence[int]) -> T.StructType:
    keys = ["fr_orig", "dms_orig", "dms_dest", "fr_dest", "fr_inmode", "dms_mode", "fr_outmode", "sctg2",
            "trade_type", "dist_band"]
    return text_schema(keys + [f"{m}_{y}" for m in ("tons", "value", "tmiles") for y in years])


# Columns of the landed monthly trade and indicator files.
RAW_TRADE_COLUMNS = ["trdtype", "usastate", "commodity2", "disagmot", "mexstate", "canprov", "country", "value",
                     "shipwt", "freight_charges", "df", "contcode", "month", "year"]
RAW_TRADE_SCHEMA = text_schema(RAW_TRADE_COLUMNS)

RAW_INDICATOR_COLUMNS = ["obs_date", "tsi_freight", "tsi_freight_c", "vmt", "rail_frt_carloads",
                         "rail_frt_intermodal", "petroleum", "natural_gas", "waterborne", "inv_to_sales", "ind_pro"]
RAW_INDICATOR_SCHEMA = text_schema(RAW_INDICATOR_COLUMNS)

# Required columns of the arriving files (a subset check: extra columns are allowed, names
# compare without case, as headers arrive in either case).
REQUIRED_SHIPMENT_COLUMNS = ["fr_orig", "dms_orig", "dms_dest", "fr_dest", "dms_mode", "sctg2", "trade_type"]
REQUIRED_TRADE_COLUMNS = ["TRDTYPE", "USASTATE", "COMMODITY2", "DISAGMOT", "COUNTRY", "VALUE", "SHIPWT", "MONTH", "YEAR"]
REQUIRED_INDICATOR_COLUMNS = ["OBS_DATE", "TSI_Freight", "VMT", "RAIL_FRT_CARLOADS", "PETROLEUM", "WATERBORNE", "INV_TO_SALES"]


def required_shipment_columns(years: Sequence[int]) -> list[str]:
    """The keys, and every measure of the first and the last year that the file covers."""
    ends = sorted({years[0], years[-1]}) if years else []
    return REQUIRED_SHIPMENT_COLUMNS + [f"{m}_{y}" for m in ("tons", "value", "tmiles") for y in ends]


# The record's columns up to skipped.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), True),
    T.StructField("source_url", T.StringType(), True),
    T.StructField("filename", T.StringType(), True),
    T.StructField("path", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("sha256", T.StringType(), True),
    T.StructField("skipped", T.BooleanType(), False),
    T.StructField("reason", T.StringType(), True),
    T.StructField("arrival", T.LongType(), True),
])

# Declared schemas of the driver tables the analogue reads.  A declared schema
# spares Spark the footer-reading job it runs per read to infer one, and pins
# the types: a file that disagrees fails at scan time instead of silently
# changing a column's type.
DRIVER_TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
