from tradelanes.functions.scalar import (  # noqa: F401
    band,
    capped_growth_pct,
    col_of,
    growth_pct,
    safe_ratio,
    surrogate_key,
    to_double,
)
