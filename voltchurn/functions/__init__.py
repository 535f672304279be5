"""Column expressions: every function here returns a ``Column`` and runs JVM-side."""

from voltchurn.functions.exprs import (  # noqa: F401
    clip_lower0,
    cut,
    cut_rank,
    days_between,
    flag,
    in_set_flag,
    month_key,
    months_between_days,
    nan_to_null,
    normalize_month,
    safe_div,
    tariff_tier,
    is_holiday,
)
