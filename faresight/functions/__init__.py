"""Column-level helpers (scalar functions and small macros), all JVM-side."""

from faresight.functions.columns import (  # noqa: F401
    PAYMENT_TYPE_DESCRIPTIONS,
    boundaries,
    day_range,
    elapsed,
    exact_mean,
    keep_keys,
    money,
    month_start,
    on_day_formatted,
    parse_timestamp,
    payment_description,
    row_hash,
    safe_cast,
    seconds_between,
    since_days,
    snake_case,
    snake_case_columns,
    surrogate_key,
)
