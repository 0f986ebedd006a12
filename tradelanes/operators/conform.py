"""Typed projection, strict or quarantining casts, validity filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = Sequence[tuple[str | Column, str, str | None]]  # (source, target name, type or None)


def _typed(src: str | Column, typ: str | None, on_error: str, name: str) -> Column:
    c = F.col(src) if isinstance(src, str) else src
    if typ is None:
        return c
    if on_error == "fail":
        # Strict whatever the session's ANSI setting: a non-NULL source that
        # does not convert stops the job with the column name in the message.
        t = c.try_cast(typ)
        return F.when(c.isNotNull() & t.isNull(),
                      F.raise_error(F.concat(F.lit(f"cannot cast column {name} to {typ}: '"),
                                             c.cast("string"), F.lit("'")))
                      ).otherwise(t).cast(typ)
    if on_error in ("null", "quarantine"):
        return c.try_cast(typ)
    raise ValueError(f"on_error must be 'fail', 'null' or 'quarantine', got {on_error!r}")


def conform(df: DataFrame, spec: Spec, on_error: str = "fail", keep_source: bool = False) -> DataFrame:
    """Rename and cast in one projection.

    ``on_error='fail'`` raises on the first bad value; ``'null'`` turns it into
    NULL; ``'quarantine'`` does the same and adds ``_bad_columns``, the array of
    target columns whose non-NULL source did not convert (empty when clean).
    """
    cols = [_typed(src, typ, on_error, dst).alias(dst) for src, dst, typ in spec]
    if on_error != "quarantine":
        return df.select(*cols, *([F.col(c) for c in df.columns] if keep_source else []))
    bad = []
    for src, dst, typ in spec:
        if typ is None:
            continue
        c = F.col(src) if isinstance(src, str) else src
        bad.append(F.when(c.isNotNull() & c.try_cast(typ).isNull(), F.lit(dst)))
    bad_arr = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<string>")
    return df.select(*cols, bad_arr.alias("_bad_columns"))


def split_quarantine(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the output of ``conform(..., on_error='quarantine')`` into clean
    rows (without the marker column) and quarantined rows (with it)."""
    bad = F.size("_bad_columns") > 0
    return conformed.where(~bad).drop("_bad_columns"), conformed.where(bad)


def valid_rows(df: DataFrame, nonneg: Sequence[str] = (), nonempty: Sequence[str] = (),
               not_null: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose ``nonneg`` columns are >= 0 (NULL fails), whose
    ``nonempty`` text columns are neither NULL nor '', and whose ``not_null``
    columns are not NULL.  One filter, pushed to the scan where possible."""
    cond = F.lit(True)
    for c in nonneg:
        cond = cond & (F.col(c) >= 0)
    for c in nonempty:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != F.lit(""))
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)
