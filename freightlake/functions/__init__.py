from freightlake.functions.expressions import (  # noqa: F401
    critical_stop,
    duration_hours,
    duration_minutes,
    invalid_status,
    lookback,
    mask_hash,
    mask_text,
    pct_sla_used,
    round_half_up,
    sla_violated,
    status_norm,
    surrogate_key,
    ts_literal,
    unknown_member,
)
