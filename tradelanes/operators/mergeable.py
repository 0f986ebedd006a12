"""Aggregates that merge: sets of codes, moments and column profiles.

Each is computed once for small groups (a lane, a month) and merged to any coarser group without reading rows again, so a new
month costs only its own rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.operators.quality import REPORT_COLUMNS
from tradelanes.sources import versions

WORD = 64  # codes in a word of a set

# ---------------------------------------------------------------- distinct codes (A2)


def _words(name: str, largest: int) -> list[str]:
    return [f"{name}__{k}" for k in range(largest // WORD + 1)]


def code_sets(df: DataFrame, keys: Sequence[str], codes: Mapping[str, tuple[str | Column, int]], sketched: Mapping[str, str | Column] | None = None,
              lgk: int = 12) -> DataFrame:
    """The sets of codes that occur in each group, in one aggregate for all columns (A2).

    ``codes`` gives for a set its column and largest code (a dimension's, from 0): a set is one word of 64 bits for every
    64 codes, so it adds 8 bytes to a row of the shuffle where a bitmap of fixed size would add 4 KB, and nothing is expanded.
    A code outside its range is an error; NULLs are in no set.  ``sketched`` gives columns without such a range: a HyperLogLog
    sketch stands for their set."""
    aggs = []
    for name, (column, largest) in codes.items():
        code = (F.col(column) if isinstance(column, str) else column).cast("long")
        outside = F.when((code < 0) | (code > largest), F.raise_error(F.concat(F.lit(f"{name}: code outside 0 to {largest}: "), code.cast("string"))).cast("long"))
        for k, word in enumerate(_words(name, largest)):
            bit = F.when(F.floor(code / WORD) == k, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code, F.lit(WORD)).cast("int")))
            aggs.append(F.bit_or(F.coalesce(outside, bit) if k == 0 else bit).alias(word))
    aggs += [F.hll_sketch_agg(column, lgk).alias(f"{name}__sketch") for name, column in (sketched or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def merge_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets of finer groups merged to those of ``keys`` (none: of everything)."""
    names = [c for c in sets.columns if "__" in c]
    return sets.groupBy(*keys).agg(*[(F.hll_union_agg(c) if c.endswith("__sketch") else F.bit_or(c)).alias(c) for c in names])


def set_counts(sets: DataFrame) -> DataFrame:
    """The number of codes in every set, exact for words, estimated for sketches."""
    names: dict[str, list[str]] = {}
    for c in sets.columns:
        if "__" in c:
            names.setdefault(c.split("__")[0], []).append(c)
    size = lambda c: F.hll_sketch_estimate(c) if c.endswith("__sketch") else F.bit_count(F.coalesce(F.col(c), F.lit(0)))
    counts = [sum((size(c) for c in words[1:]), size(words[0])).cast("long").alias(name) for name, words in names.items()]
    return sets.select(*[c for c in sets.columns if "__" not in c], *counts)


# ---------------------------------------------------------------- moments

MOMENTS = "struct<n:bigint,mean:double,m2:double>"


def moments_of(column: str | Column) -> Column:
    """Aggregate: count, mean and sum of squared distances from it, of the non-NULL values."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    n = F.count(c)
    return F.struct(n.alias("n"), F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(c) * n, F.lit(0.0)).alias("m2"))


def merged_moments(column: str, order: Sequence[str]) -> Column:
    """Aggregate: moments of groups merged pairwise in the order of ``order`` (unique), so the result does not depend on how the
    rows are spread, nor on which of the groups were there before."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(column).alias("m"))))

    def add(a: Column, p: Column) -> Column:
        b, n = p["m"], a["n"] + p["m"]["n"]
        gap = b["mean"] - a["mean"]
        return F.when(b["n"] == 0, a).otherwise(F.struct(
            n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2")))

    return F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")), add)


def mean_of(moments: str) -> Column:
    return F.when(F.col(f"{moments}.n") > 0, F.col(f"{moments}.mean"))


def stddev_of(moments: str) -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.when(F.col(f"{moments}.n") > 1, F.sqrt(F.col(f"{moments}.m2") / (F.col(f"{moments}.n") - 1)))


def add_to_baseline(df: DataFrame, base: str, season: str, period: str, columns: Mapping[str, str]) -> int:
    """W8, part by part: the seasonal moments of the periods in ``df`` (a period's rows whole), put beside those of the other periods
    in a versioned table.  Only ``df`` is read."""
    sums = df.groupBy(season, period).agg(*[moments_of(c).alias(f"{p}_moments") for c, p in columns.items()])
    return versions.replace(sums, base, (period,))


def baseline(parts: DataFrame, season: str, period: str) -> DataFrame:
    """Mean and sample deviation of every season from the stored moments of its periods: ``{prefix}_mean``, ``{prefix}_stddev``."""
    prefixes = [c.removesuffix("_moments") for c in parts.columns if c.endswith("_moments")]
    merged = parts.groupBy(season).agg(*[merged_moments(f"{p}_moments", [period]).alias(p) for p in prefixes])
    return merged.select(season, *[x for p in prefixes for x in (mean_of(p).alias(f"{p}_mean"), stddev_of(p).alias(f"{p}_stddev"))])


# ---------------------------------------------------------------- column profiles (Q5, Q6)


def profile_parts(df: DataFrame, by: Sequence[str], numeric: Sequence[str], other: Sequence[str] = (), lgk: int = 12) -> DataFrame:
    """A profile of every column in every partition, from one aggregate: rows, NULLs, least and largest value, moments,
    a HyperLogLog sketch of the distinct values and a quantile sketch.  ``other`` columns have no numbers."""
    none = lambda kind: F.lit(None).cast(kind)
    structs = []
    for c in [*numeric, *other]:
        v = F.col(c).cast("double") if c in numeric else None
        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(c).isNull(), 1)).alias("n_nulls"),
            (F.min(v) if v is not None else none("double")).alias("low"), (F.max(v) if v is not None else none("double")).alias("high"),
            (moments_of(v) if v is not None else none(MOMENTS)).alias("moments"), F.hll_sketch_agg(F.col(c).cast("string"), lgk).alias("distinct"),
            (F.kll_sketch_agg_double(v) if v is not None else none("binary")).alias("quantiles")))
    return df.groupBy(*by).agg(F.array(*structs).alias("p")).select(*by, F.inline("p"))


def update_profile(df: DataFrame, base: str, by: Sequence[str], numeric: Sequence[str], other: Sequence[str] = ()) -> int:
    """Put the profiles of the partitions in ``df`` (a partition's rows whole) beside those of the others; the version."""
    return versions.replace(profile_parts(df, by, numeric, other), base, by)


def merged_profile(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One profile a column from those of its partitions: n_rows, n_nulls, low, high, mean, stddev, n_distinct, q10, q50, q90."""
    merged = parts.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.when(F.count("moments") > 0, merged_moments("moments", by)).alias("m"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("q"))
    at = lambda share: F.when(F.col("m.n") > 0, F.kll_sketch_get_quantile_double("q", F.lit(share)))
    return merged.select("column_name", "n_rows", "n_nulls", "low", "high", mean_of("m").alias("mean"), stddev_of("m").alias("stddev"), "n_distinct",
                         at(0.1).alias("q10"), at(0.5).alias("q50"), at(0.9).alias("q90"))


def profile_report(now: DataFrame, table: str, min_rows: int = 1, not_null: Sequence[str] = (), bounds: Mapping[str, tuple] | None = None,
                   variance: Sequence[str] = (), distinct: Mapping[str, float] | None = None, before: DataFrame | None = None,
                   drift: float = 0.5, columns: Sequence[str] = ()) -> DataFrame:
    """Rules on a merged profile, as report rows (rule, table, column, failures, passed); no row of the table is read.

    row_count, not_null, range, variance and distinct_share (least share among non-NULL values) as in ``quality``, one failure
    for each column; ``drift`` for ``columns`` against the profile of the run before: the median has moved by more than that share of
    the range between the first and the last tenth, or the column has gone.  A profile without columns fails its row count."""
    rules = [("row_count", c, F.col("n_rows") < min_rows) for c in ["*"]]
    rules += [("not_null", c, F.col("n_nulls") > 0) for c in not_null]
    for c, (low, high) in (bounds or {}).items():
        rules.append(("range", c, (F.col("low") < F.lit(low) if low is not None else F.lit(False)) | (F.col("high") > F.lit(high) if high is not None else F.lit(False))))
    rules += [("variance", c, ~(F.coalesce("stddev", F.lit(0.0)) > 0)) for c in variance]
    rules += [("distinct_share", c, F.col("n_distinct") < F.lit(least) * (F.col("n_rows") - F.col("n_nulls"))) for c, least in (distinct or {}).items()]
    if before is not None:
        old = before.select("column_name", *[F.col(c).alias(f"old_{c}") for c in ("q10", "q50", "q90")])
        now = now.join(old, "column_name", "left")
        moved = F.abs(F.col("q50") - F.col("old_q50")) > F.lit(drift) * (F.col("old_q90") - F.col("old_q10"))
        rules += [("drift", c, F.coalesce(moved, F.col("q50").isNull() & F.col("old_q50").isNotNull())) for c in columns]
    entries = [F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"),
                        (F.count(F.when(F.lit(True) if c == "*" else F.col("column_name") == c, 1)) == 0).alias("missing"),
                        F.count(F.when((F.lit(True) if c == "*" else F.col("column_name") == c) & bad, 1)).alias("bad")) for rule, c, bad in rules]
    out = now.agg(F.array(*entries).alias("e")).select(F.inline("e"))
    failures = F.greatest(F.col("bad"), F.col("missing").cast("long")).cast("bigint")
    return out.select("rule", F.lit(table).alias("table_name"), "column_name", failures.alias("failures"), (failures == 0).alias("passed")).select(*REPORT_COLUMNS)
