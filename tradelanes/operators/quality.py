"""Data quality rules and the gate between layers (Q1-Q7).

Every rule returns rows of the same shape - ``rule, table_name,
column_name, failures, passed`` - so a report is a plain union.  Each rule is
one distributed pass (a grouped aggregate or an anti join); only the final
report, one row per rule, is ever brought to the driver by ``gate``.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.functions.scalar import col_of

REPORT_COLUMNS = ["rule", "table_name", "column_name", "failures", "passed"]


class GateFailed(Exception):
    """Raised by ``gate`` when at least one rule did not pass."""

    def __init__(self, failed_rows):
        self.failed = failed_rows
        lines = [f"{r['rule']}({r['table_name']}.{r['column_name']}): {r['failures']}" for r in failed_rows]
        super().__init__("quality gate failed: " + "; ".join(lines))


def _rows(df_one_row: DataFrame, items: Sequence[tuple[str, str, str]], table: str) -> DataFrame:
    """Turn a one-row frame of failure counts into report rows (one per item)."""
    entries = [F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                        F.lit(column).alias("column_name"), F.col(alias).cast("bigint").alias("failures"))
               for rule, column, alias in items]
    out = df_one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return out.withColumn("passed", F.col("failures") == 0)


def _not_null_aggs(columns: Sequence[str], tag: str = "n"):
    aggs = [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"_{tag}{i}") for i, c in enumerate(columns)]
    return aggs, [("not_null", c, f"_{tag}{i}") for i, c in enumerate(columns)]


def _accepted_aggs(accepted: Sequence[tuple[str, Sequence[str]]], tag: str = "a"):
    aggs, items = [], []
    for i, (column, values) in enumerate(accepted):
        bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
        aggs.append(F.count(F.when(bad, F.lit(1))).alias(f"_{tag}{i}"))
        items.append(("accepted_values", column, f"_{tag}{i}"))
    return aggs, items


def _range_aggs(bounds: Sequence[tuple[str, float | None, float | None]], min_rows: int | None, tag: str = "r"):
    aggs, items = [], []
    if min_rows is not None:
        aggs.append(F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0)).alias(f"_{tag}c"))
        items.append(("row_count", "*", f"_{tag}c"))
    for i, (c, lo, hi) in enumerate(bounds):
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(c) < F.lit(lo))
        if hi is not None:
            cond = cond | (F.col(c) > F.lit(hi))
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"_{tag}{i}"))
        items.append(("range", c, f"_{tag}{i}"))
    return aggs, items


def _variance_aggs(columns: Sequence[str], tag: str = "v"):
    aggs = [F.when(F.coalesce(F.stddev_samp(c), F.lit(0.0)) > 0, F.lit(0)).otherwise(F.lit(1)).alias(f"_{tag}{i}")
            for i, c in enumerate(columns)]
    return aggs, [("variance", c, f"_{tag}{i}") for i, c in enumerate(columns)]


def not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Q1: NULL count of many columns in one aggregate pass."""
    aggs, items = _not_null_aggs(columns)
    return _rows(df.agg(*aggs), items, table)


def unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Q2: number of non-NULL key values that occur more than once.

    The per-key count is a partial aggregate, so a hot key costs one row per
    map task in the shuffle."""
    k = [F.col(c) for c in keys]
    nn = reduce(lambda a, b: a & b, [c.isNotNull() for c in k])
    dup = df.where(nn).groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    agg = dup.agg(F.count(F.lit(1)).alias("_d"))
    return _rows(agg, [("unique", ",".join(keys), "_d")], table)


def accepted_values(df: DataFrame, column: str, values: Sequence[str], table: str) -> DataFrame:
    """Q3: rows whose non-NULL value is outside the accepted list."""
    aggs, items = _accepted_aggs([(column, values)])
    return _rows(df.agg(*aggs), items, table)


def relationships(child: DataFrame, child_col: str | Column, parent: DataFrame, parent_col: str | Column,
                  table: str, column: str) -> DataFrame:
    """Q4: child rows whose non-NULL key has no parent row.

    The child keys are first counted per key (partial aggregate), and the anti
    join runs on distinct keys."""
    ck = child.where(col_of(child_col).isNotNull()).groupBy(col_of(child_col).alias("_k")).agg(
        F.count(F.lit(1)).alias("_rows"))
    pk = parent.select(col_of(parent_col).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    orphans = ck.join(pk, "_k", "left_anti")
    agg = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_o"))
    return _rows(agg, [("relationships", column, "_o")], table)


@dataclass(frozen=True)
class Unique:
    """Q2 as a rule of ``keyed``."""

    df: DataFrame
    keys: Sequence[str]
    table: str


@dataclass(frozen=True)
class Relationship:
    """Q4 as a rule of ``keyed``."""

    child: DataFrame
    child_col: str | Column
    parent: DataFrame
    parent_col: str | Column
    table: str
    column: str


def _key(columns: Sequence[Column]) -> Column:
    """The values of a key as one text, different for different keys; null if one of them is null."""
    texts = [c.cast("string") for c in columns]
    return texts[0] if len(texts) == 1 else F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


def keyed(rules: Sequence[Unique | Relationship]) -> DataFrame:
    """Q2 and Q4 of any tables in one pass: the keys of all rules are stacked as (rule, key, side) and counted by one
    aggregate, so there are two exchanges however many rules there are.  The same report rows as the separate rules.

    Keys are counted before the shuffle, so a hot key is one row for each task; they are compared whole, so none is
    taken for another.  Key columns of both sides compare as text."""
    stacked, names = [], []
    for nr, rule in enumerate(rules):
        sides = ([(rule.df, [F.col(c) for c in rule.keys], 0)] if isinstance(rule, Unique) else
                 [(rule.child, [col_of(rule.child_col)], 0), (rule.parent, [col_of(rule.parent_col)], 1)])
        stacked += [df.select(F.lit(nr).alias("rule"), _key(columns).alias("key"), F.lit(side).alias("side")).where("key is not null") for df, columns, side in sides]
        names.append(("unique", rule.table, ",".join(rule.keys)) if isinstance(rule, Unique) else ("relationships", rule.table, rule.column))
    counted = reduce(lambda a, b: a.unionAll(b), stacked).groupBy("rule", "key").agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("n"), F.max("side").alias("side"))
    uniques = F.col("rule").isin([nr for nr, rule in enumerate(rules) if isinstance(rule, Unique)])
    failures = F.when(uniques, (F.col("n") > 1).cast("long")).when(F.col("side") == 0, F.col("n")).otherwise(F.lit(0).cast("long"))
    # A rule whose table has no key is in the report all the same
    listed = F.array(*[F.struct(F.lit(nr).alias("nr"), *[F.lit(v).alias(c) for c, v in zip(REPORT_COLUMNS, name)]) for nr, name in enumerate(names)])
    found = counted.groupBy("rule").agg(F.sum(failures).alias("failures")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "failures"))).alias("found"))
    out = found.select("found", F.explode(listed).alias("r")).select(
        *[F.col(f"r.{c}").alias(c) for c in REPORT_COLUMNS[:3]], F.coalesce(F.try_element_at("found", F.col("r.nr")), F.lit(0)).cast("bigint").alias("failures"))
    return out.withColumn("passed", F.col("failures") == 0)


def _distinct_aggs(shares: Sequence[tuple[str, float]], tag: str = "d"):
    aggs = [F.when(F.count(c) * F.lit(float(least)) > F.coalesce(F.approx_count_distinct(c, 0.01), F.lit(0)), F.lit(1)).otherwise(F.lit(0)).alias(f"_{tag}{i}")
            for i, (c, least) in enumerate(shares)]
    return aggs, [("distinct_share", c, f"_{tag}{i}") for i, (c, _) in enumerate(shares)]


def ranges(df: DataFrame, bounds: Sequence[tuple[str, float | None, float | None]], table: str,
           min_rows: int = 1) -> DataFrame:
    """Q5: row count at least ``min_rows`` and values inside [lo, hi], in one pass.

    For the row count rule ``failures`` is the shortfall (0 when enough rows)."""
    aggs, items = _range_aggs(bounds, min_rows)
    return _rows(df.agg(*aggs), items, table)


def variance(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Q6: a column fails when its sample standard deviation is NULL or 0
    (a constant column makes every z-score NULL)."""
    aggs, items = _variance_aggs(columns)
    return _rows(df.agg(*aggs), items, table)


def profile(df: DataFrame, table: str, not_null: Sequence[str] = (),
            accepted: Sequence[tuple[str, Sequence[str]]] = (),
            bounds: Sequence[tuple[str, float | None, float | None]] = (), min_rows: int | None = None,
            variance: Sequence[str] = (), distinct: Sequence[tuple[str, float]] = ()) -> DataFrame:
    """Q1, Q3, Q5, Q6 of one table in a single aggregate pass.

    ``distinct`` has columns with the least share of distinct values among their non-NULL ones (Q6; counted by a
    HyperLogLog sketch of 1 % error, so a column of the least share plus or minus that may go either way).

    The same report rows as the separate rules, but the table is scanned
    once: with several rules per table the separate form scans it once per
    rule (a union does not share scans)."""
    parts = [_not_null_aggs(not_null), _accepted_aggs(accepted), _range_aggs(bounds, min_rows),
             _variance_aggs(variance), _distinct_aggs(distinct)]
    aggs = [x for a, _ in parts for x in a]
    items = [x for _, i in parts for x in i]
    if not aggs:
        raise ValueError("profile needs at least one rule")
    return _rows(df.agg(*aggs), items, table)


def report(parts: Sequence[DataFrame]) -> DataFrame:
    """Q7: union of rule results."""
    return reduce(lambda a, b: a.unionByName(b), [p.select(*REPORT_COLUMNS) for p in parts])


def gate(rep: DataFrame, raise_on_failure: bool = True, warn_only: Collection[tuple[str, str, str]] = ()) -> bool:
    """Q7: True when every rule passed; otherwise raise ``GateFailed`` (or
    return False).  The report has one row per rule, so collecting it is bounded.
    Rules in ``warn_only`` (rule, table, column) may fail: they are in the report but do not close the gate."""
    failed = [r.asDict() for r in rep.where(~F.col("passed")).collect()]
    failed = [r for r in failed if (r["rule"], r["table_name"], r["column_name"]) not in warn_only]
    if failed and raise_on_failure:
        raise GateFailed(failed)
    return not failed
