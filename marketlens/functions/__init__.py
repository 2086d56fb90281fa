from marketlens.functions.scalar import (  # noqa: F401
    ALERT_TYPES, DROP_THRESHOLD, TRADING_DAYS, VOLATILITY_THRESHOLD,
    ZSCORE_THRESHOLD, alert_severity, deterministic_id, direction,
    guarded_ratio, minute_bucket, nanos_to_date, pct_change, sign_class,
)
