"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from Spark's built-in functions, so
it stays inside whole-stage codegen; nothing is evaluated in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's for equal results ---------
# Alert thresholds (strict ">" comparisons).
VOLATILITY_THRESHOLD = 0.02
DROP_THRESHOLD = 0.03
ZSCORE_THRESHOLD = 2.0
# Trading days per year used to annualise volatility and Sharpe ratio.
TRADING_DAYS = 252
# Alert type names, in the order the rules are evaluated.
ALERT_TYPES = ("HIGH_VOLATILITY", "PRICE_DROP", "PRICE_ANOMALY")
# Severity keywords, tested on the lower-cased alert type in this order.
SEVERITY_HIGH_WORDS = ("high", "breach", "loss")
SEVERITY_MEDIUM_WORDS = ("warn", "medium")
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guarded_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0`` else 0.0 (NULL inputs count as 0.0)."""
    num, den = F.coalesce(_c(num), F.lit(0.0)), F.coalesce(_c(den), F.lit(0.0))
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def pct_change(price, prev) -> Column:
    """Percent change rounded to 4 places; 0.0 when there is no (or a zero) previous."""
    price, prev = _c(price), _c(prev)
    return F.when(prev.isNotNull() & (prev != 0),
                  F.round((price - prev) / prev * 100, 4)).otherwise(F.lit(0.0))


def direction(price, prev) -> Column:
    """'up' / 'down' / 'flat' against the previous value, NULL without one."""
    price, prev = _c(price), _c(prev)
    return (F.when(prev.isNull(), F.lit(None).cast("string"))
            .when(price > prev, F.lit("up"))
            .when(price < prev, F.lit("down"))
            .otherwise(F.lit("flat")))


def sign_class(x) -> Column:
    """'positive' / 'negative' / 'zero' (NULL stays NULL)."""
    x = _c(x)
    return (F.when(x > 0, F.lit("positive")).when(x < 0, F.lit("negative"))
            .when(x == 0, F.lit("zero")))


def alert_severity(alert_type) -> Column:
    """Severity from the alert type text: high / medium / low."""
    t = F.lower(_c(alert_type))
    high = None
    for w in SEVERITY_HIGH_WORDS:
        cond = t.contains(w)
        high = cond if high is None else high | cond
    medium = None
    for w in SEVERITY_MEDIUM_WORDS:
        cond = t.contains(w)
        medium = cond if medium is None else medium | cond
    return (F.when(high, F.lit("high")).when(medium, F.lit("medium"))
            .otherwise(F.lit("low")))


def nanos_to_date(nanos) -> Column:
    """Epoch nanoseconds (BIGINT) to DATE (UTC calendar day, session-zone free)."""
    n = _c(nanos).cast("long")
    day = F.lit(86_400_000_000_000)
    # (n - n mod day) is an exact multiple of a day: the rounded quotient is exact.
    return F.date_from_unix_date(F.round((n - F.pmod(n, day)) / day).cast("int"))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_instant(ntz) -> Column:
    """TIMESTAMP_NTZ read as UTC wall-clock -> TIMESTAMP instant (session-zone free)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _c(ntz))
    return F.timestamp_micros(micros)


def utc_wall_clock(ts) -> Column:
    """TIMESTAMP instant -> its UTC wall-clock as TIMESTAMP_NTZ (session-zone free)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)),
                           F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def minute_bucket(ts) -> Column:
    """Truncate a timestamp to its minute (as TIMESTAMP_NTZ)."""
    return F.date_trunc("minute", _c(ts)).cast("timestamp_ntz")


def deterministic_id(*parts) -> Column:
    """A 36-character id (8-4-4-4-12 hex) from the SHA-256 of the parts.

    Equal inputs give equal ids, so a replayed micro-batch rewrites the same
    alert ids instead of inventing new random ones.
    """
    h = F.sha2(F.concat_ws("|", *[_c(p).cast("string") for p in parts]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.substring(h, 13, 4), F.substring(h, 17, 4),
                       F.substring(h, 21, 12))
