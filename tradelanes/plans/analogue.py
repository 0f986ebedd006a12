"""Analogue inputs built by Spark from the driver tables.

The freight source files are not available, so each input of the pipeline is
derived from the TPC-H-like tables (SURVEY §7.3):

* shipment fact: ``lineitem`` joined to ``orders``, ``customer``, ``supplier``
  and ``part``; origin zone = supplier nation, destination zone = customer
  nation, commodity = part type, mode = order priority, year = ship year;
  tons / value / ton-miles = quantity / extended price / quantity * size.
* region dimension: ``nation`` joined to ``region``.
* commodity and mode dimensions: fixed seeds, like the seed CSVs they stand for.
* indicators: ``events`` per hour (season = hour of day).
* monthly trade: ``orders`` per year and month.
* raw text tables: the same data cast to text, as landed CSV would be.

All of it is lazy DataFrame code; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelanes.operators.enrich import zone_key
from tradelanes.session import read_table

# Analogue commodity seed (part type, code, name, category).
COMMODITY_SEED = [
    ("ECONOMY", 1, "Economy", "Bulk"),
    ("LARGE", 2, "Large", "Manufactured"),
    ("MEDIUM", 3, "Medium", "Manufactured"),
    ("PROMO", 4, "Promo", "Consumer"),
    ("SMALL", 5, "Small", "Consumer"),
    ("STANDARD", 6, "Standard", "Bulk"),
]
# Analogue mode seed (code, name, category); the code is the
# leading digit of the order priority, the name the text after the dash.
MODE_SEED = [
    (1, "URGENT", "Expedited"),
    (2, "HIGH", "Expedited"),
    (3, "MEDIUM", "Standard"),
    (4, "NOT SPECIFIED", "Standard"),
    (5, "LOW", "Deferred"),
]
# The mode whose share decline is flagged (the truck analogue),
# trade type and distance band codes.
DECLINE_MODE_NAME = "URGENT"
TRADE_TYPE_CODES = [("A", 1), ("N", 2), ("R", 3)]
DIST_BAND_CODES = [("F", 1), ("O", 2)]

MEASURE_TYPE = "decimal(18,2)"
LANE_KEYS = ["origin_zone", "destination_zone", "commodity_code", "mode_code"]


def _code_map(c: Column, pairs) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr


def commodity_code_of(p_type: Column) -> Column:
    return _code_map(p_type, [(t, code) for t, code, _, _ in COMMODITY_SEED]).cast("int")


def mode_code_of(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int")


# ---------------------------------------------------------------- dimensions

def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
            .select(F.col("n_nationkey").alias("region_code"),
                    F.col("n_name").alias("region_name"),
                    F.col("r_name").alias("state")))


def _seed(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few fixed rows as literals: the optimizer knows their size, so a join with them is planned as a broadcast."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def commodity_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, [(code, name, cat) for _, code, name, cat in COMMODITY_SEED], ["commodity_code", "commodity_name", "commodity_category"])


def mode_dim(spark: SparkSession) -> DataFrame:
    return _seed(spark, MODE_SEED, ["mode_code", "mode_name", "mode_category"])


# ---------------------------------------------------------------- fact

def shipment_lines(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    """One row per line item with lane keys, year and the three measures.

    All joins are on the tables' keys and left to the optimizer: at scale every
    one of them is a shuffled join (the dimension-like tables grow with the
    data), at small scale AQE turns them into broadcasts from runtime sizes.
    """
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    oc = o.join(c, o.o_custkey == c.c_custkey, "inner")
    j = (li.join(p, li.l_partkey == p.p_partkey, "inner")
         .join(s, li.l_suppkey == s.s_suppkey, "inner")
         .join(oc, li.l_orderkey == oc.o_orderkey, "inner"))
    cols = [
        zone_key("s_nationkey").alias("origin_zone"),
        zone_key("c_nationkey").alias("destination_zone"),
        commodity_code_of(F.col("p_type")).alias("commodity_code"),
        mode_code_of(F.col("o_orderpriority")).alias("mode_code"),
        F.year("l_shipdate").alias("year"),
        F.col("l_quantity").cast(MEASURE_TYPE).alias("tons"),
        F.col("l_extendedprice").cast(MEASURE_TYPE).alias("value"),
        (F.col("l_quantity") * F.col("p_size")).cast(MEASURE_TYPE).alias("tmiles"),
    ]
    if extra:
        cols += [
            _code_map(F.col("l_returnflag"), TRADE_TYPE_CODES).alias("trade_type"),
            _code_map(F.col("l_linestatus"), DIST_BAND_CODES).alias("dist_band"),
            F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_shipdate"),
        ]
    return j.select(*cols)


# ---------------------------------------------------------------- raw text tables

# Key columns of the landed shipment file.
RAW_KEY_COLUMNS = ["fr_orig", "dms_orig", "dms_dest", "fr_dest", "fr_inmode", "dms_mode",
                   "fr_outmode", "sctg2", "trade_type", "dist_band"]


def shipment_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Years that the wide table has columns for: from the first to the last ship year, two numbers read from the data."""
    year = F.year("l_shipdate")
    first, last = read_table(spark, sf_dir, "lineitem").agg(F.min(year), F.max(year)).first()
    return list(range(first, last + 1)) if first is not None else []


def raw_shipments(spark: SparkSession, sf_dir: str, years: Sequence[int], corrupt: bool = False) -> DataFrame:
    """Wide, all-text shipment table: one row per shipment key, one column per
    measure and year, NULL for years without shipments.

    ``corrupt=True`` replaces the first-year tonnage of about 1/16 of the keys
    (those whose md5 starts with '0') by the text 'n/a', for the quarantine path.
    """
    lines = shipment_lines(spark, sf_dir, extra=True)
    keys = [
        F.lit(None).cast("string").alias("fr_orig"),
        F.col("origin_zone").alias("dms_orig"),
        F.col("destination_zone").alias("dms_dest"),
        F.lit(None).cast("string").alias("fr_dest"),
        F.lit(None).cast("string").alias("fr_inmode"),
        F.col("mode_code").cast("string").alias("dms_mode"),
        F.lit(None).cast("string").alias("fr_outmode"),
        F.lpad(F.col("commodity_code").cast("string"), 2, "0").alias("sctg2"),
        F.col("trade_type").cast("string").alias("trade_type"),
        F.col("dist_band").cast("string").alias("dist_band"),
    ]
    aggs = []
    for m in ("tons", "value", "tmiles"):
        for y in years:
            aggs.append(F.sum(F.when(F.col("year") == y, F.col(m))).cast("decimal(38,2)")
                        .cast("string").alias(f"{m}_{y}"))
    wide = lines.groupBy(*keys).agg(*aggs)
    if corrupt:
        first = f"tons_{years[0]}"
        flag = F.substring(F.md5(F.concat_ws("|", "dms_orig", "dms_dest", "dms_mode", "sctg2",
                                             "trade_type", "dist_band")), 1, 1) == F.lit("0")
        wide = wide.withColumn(first, F.when(flag, F.lit("n/a")).otherwise(F.col(first)))
    return wide


def raw_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly indicator series from ``events``, all text like the landed file."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    cnt = lambda t: F.count(F.when(et == t, F.lit(1)))
    value = F.col("value").cast("decimal(18,2)")
    g = e.groupBy(F.date_format("ts", "MM/dd/yyyy HH:00").alias("obs_date")).agg(
        (F.sum(value).cast("double") / F.count(value).cast("double")).alias("tsi_freight"),
        F.round(F.sum(F.when(et == "purchase", value)).cast("double")
                / F.nullif(F.sum(value).cast("double"), F.lit(0.0)) * F.lit(100), 2).alias("tsi_freight_c"),
        F.count(F.lit(1)).alias("vmt"),
        cnt("purchase").alias("rail_frt_carloads"),
        cnt("signup").alias("rail_frt_intermodal"),
        cnt("view").alias("petroleum"),
        cnt("error").alias("natural_gas"),
        cnt("click").alias("waterborne"),
        F.round(cnt("error").cast("double") / F.nullif(cnt("signup").cast("double"), F.lit(0.0)), 4)
        .alias("inv_to_sales"),
        F.count_distinct("user_id").alias("ind_pro"),
    )
    return g.select("obs_date", *[F.col(c).cast("string").alias(c) for c in g.columns if c != "obs_date"])


def raw_monthly_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cross-border trade analogue from ``orders`` x ``customer``, all text."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    g = j.groupBy(
        F.when(F.col("o_orderstatus") == "F", F.lit("1")).otherwise(F.lit("2")).alias("trdtype"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("usastate"),
        F.col("c_mktsegment").alias("commodity2"),
        F.substring("o_orderpriority", 1, 1).alias("disagmot"),
        F.col("o_orderstatus").alias("contcode"),
        F.month("o_orderdate").cast("string").alias("month"),
        F.year("o_orderdate").cast("string").alias("year"),
    ).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("value"),
        F.count(F.lit(1)).cast("string").alias("shipwt"),
    )
    return g.select(
        "trdtype", "usastate", "commodity2", "disagmot",
        F.lit(None).cast("string").alias("mexstate"),
        F.lit(None).cast("string").alias("canprov"),
        F.lit("1220").alias("country"),
        "value", "shipwt",
        F.lit(None).cast("string").alias("freight_charges"),
        F.lit("1").alias("df"),
        "contcode", "month", "year",
    )
