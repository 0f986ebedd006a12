"""Scalar column expressions shared by the operators.

All of them are plain Catalyst expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null placeholder and separator of the surrogate key macro
# (dbt_utils.generate_surrogate_key), and the growth cap bounds.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
GROWTH_FLOOR = -100
GROWTH_CEILING = 1000


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    return col_of(c).cast("double")


def safe_ratio(num: str | Column, den: str | Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """``round(num / nullif(den, 0) * scale, digits)`` computed in DOUBLE.

    Both sides are cast to double first so the result does not depend on the
    engine's decimal division rules; a zero denominator gives NULL instead of
    an ANSI divide-by-zero error.
    """
    r = to_double(num) / F.nullif(to_double(den), F.lit(0.0))
    if scale != 1.0:
        r = r * F.lit(scale)
    return F.round(r, digits) if digits is not None else r


def _change_ratio(cur: str | Column, prev: str | Column) -> Column:
    # (cur - prev) is exact when both are decimals; the division runs in double.
    diff = (col_of(cur) - col_of(prev)).cast("double")
    return diff / F.nullif(to_double(prev), F.lit(0.0)) * F.lit(100)


def growth_pct(cur: str | Column, prev: str | Column, digits: int = 2) -> Column:
    """Uncapped period-over-period growth in percent; NULL when the base is NULL or 0."""
    return F.round(_change_ratio(cur, prev), digits)


def capped_growth_pct(
    cur: str | Column,
    prev: str | Column,
    digits: int = 2,
    floor: float = GROWTH_FLOOR,
    ceiling: float = GROWTH_CEILING,
    missing_base: str = "floor",
) -> Column:
    """Growth clamped to ``[floor, ceiling]``.

    ``least``/``greatest`` skip NULLs, so with ``missing_base='floor'`` a
    missing or zero base yields ``floor`` (what the SQL of the mart computes).
    ``missing_base='null'`` keeps NULL for those rows instead.
    """
    raw = _change_ratio(cur, prev)
    capped = F.round(F.least(F.greatest(raw, F.lit(floor)), F.lit(ceiling)), digits)
    if missing_base == "floor":
        return capped
    if missing_base == "null":
        return F.when(raw.isNull(), F.lit(None).cast("double")).otherwise(capped)
    raise ValueError(f"missing_base must be 'floor' or 'null', got {missing_base!r}")


def surrogate_key(cols: Sequence[str | Column], null_placeholder: str = SURROGATE_NULL,
                  separator: str = SURROGATE_SEPARATOR, length_prefixed: bool = False) -> Column:
    """md5 over the text of ``cols`` joined by ``separator``, NULLs replaced.

    ``length_prefixed=True`` prefixes each part with its length so values that
    contain the separator can no longer collide.
    """
    parts = []
    for c in cols:
        txt = F.coalesce(col_of(c).cast("string"), F.lit(null_placeholder))
        if length_prefixed:
            txt = F.concat(F.length(txt).cast("string"), F.lit(":"), txt)
        parts.append(txt)
    return F.md5(F.concat_ws(separator, *parts))


def band(c: str | Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Threshold banding: value < cuts[0] -> labels[0], ... , else labels[-1].

    NULL input gives NULL (no band), like a display threshold.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one more label than cuts")
    x = col_of(c)
    expr = None
    for cut, label in zip(cuts, labels):
        expr = F.when(x < F.lit(cut), F.lit(label)) if expr is None else expr.when(x < F.lit(cut), F.lit(label))
    expr = expr.when(x.isNotNull(), F.lit(labels[-1]))
    return expr
