"""Cross-site line dedup by the number of distinct sites a line is seen on.

A HyperLogLog sketch for each line hash is merged by aggregation.  Lines whose estimate is too
close to the threshold for the sketch's error get an exact distinct count.  A line on enough
sites is boilerplate: it is removed everywhere but at its first place (smallest id), so no
content is lost when whole documents are copied from site to site.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.llm.common import text_key
from tradelanes.session import stored

NOT_BLANK = r"[^ \t\r\f]"  # a line needs one of these to count


def split_lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(lines: DataFrame, min_sites: int, lgk: int = 12) -> DataFrame:
    """Hashes ``h`` seen on at least ``min_sites`` distinct sites, from rows (h, site, place).
    Returns h and first, the smallest place.  Null sites count as none."""
    sketches = stored(
        lines.groupBy("h").agg(F.hll_sketch_agg("site", lgk).alias("sketch"), F.min("place").alias("first"))
        .select("h", "first", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") > 1), "sketches")
    # Three standard errors of a sketch with 2**lgk registers, and one site at least
    margin = max(1, math.ceil(3 * 1.04 / math.sqrt(2**lgk) * min_sites))
    sure = sketches.where(F.col("sites") > min_sites + margin)
    near = sketches.where(F.abs(F.col("sites") - min_sites) <= margin)
    pairs = lines.join(near.select("h"), "h", "left_semi").where("site is not null").groupBy("h", "site").agg(F.count(F.lit(1)).alias("n"))
    counts = pairs.groupBy("h").agg(F.count(F.lit(1)).alias("exact")).where(F.col("exact") >= min_sites)
    return sure.select("h", "first").unionByName(near.join(counts, "h", "left_semi").select("h", "first"))


def dedup_lines(docs: DataFrame, min_sites: int = 5, lgk: int = 12, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source") -> DataFrame:
    """Every input row with all its columns as struct ``row``, and n_lines, n_removed and ``clean``, the
    text without boilerplate lines.

    Lines end at \\n; blank lines are never removed.  A null text has no lines and stays null; a text of
    boilerplate only becomes ''.  Null sites do not count.  A removed line keeps its first place: the smallest
    (id, text key, position), null ids first; rows that repeat id and text keep it in each.  Other columns may have any names.
    """
    named = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                        F.col(site_col).cast("string").alias("__site"))
    keyed = named.withColumn("__key", text_key("__text"))
    lines = stored(
        keyed.select("__id", "__key", "__site", F.posexplode(split_lines("__text")).alias("pos", "line"))
        .where(F.col("line").rlike(NOT_BLANK))
        .select(F.xxhash64("line").alias("h"), F.col("__site").alias("site"),
                F.struct(F.col("__id").alias("id"), F.col("__key").alias("key"), "pos").alias("place")), "lines")
    found = boilerplate(lines, min_sites, lgk)
    removed = (lines.join(found, "h").where(~F.col("place").eqNullSafe(F.col("first")))
               .groupBy(F.col("place.id").alias("id"), F.col("place.key").alias("key"))
               .agg(F.collect_set("place.pos").alias("gone")))
    out = keyed.join(removed, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__key") == F.col("key")), "left")
    kept = F.filter(split_lines("__text"), lambda line, i: ~F.array_contains("gone", i))
    return out.select(
        "row", F.when(F.col("__text").isNull(), 0).otherwise(F.size(split_lines("__text"))).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("__text")).otherwise(F.array_join(kept, "\n")).alias("clean"))
