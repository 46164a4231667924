"""Column-expression helpers (all Spark built-ins, no UDFs)."""

from tickmart.functions.columns import (  # noqa: F401
    epoch_ms_to_seconds,
    epoch_ms_to_utc_date,
    epoch_ms_to_utc_ts,
    event_order,
    non_blank,
    payload_order,
    round_to,
    text_or_unknown,
    number_or_zero,
)
