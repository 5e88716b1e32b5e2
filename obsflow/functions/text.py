"""Text formatting used by the served tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capitalize_first(c) -> Column:
    """First character upper, the rest lower (``str.capitalize``), not ``initcap``."""
    s = _c(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def fixed_1dp(c) -> Column:
    """Number with one decimal, rounded half away from zero from its shortest decimal form."""
    return F.format_string("%.1f", F.round(_c(c).cast("double"), 1) + F.lit(0.0))  # + 0.0: no "-0.0"


def or_placeholder(c, placeholder: str = "?") -> Column:
    """Text of a value, or ``placeholder`` when it is missing."""
    return F.coalesce(_c(c).cast("string"), F.lit(placeholder))


def threshold_label(c, threshold: float = 0.0) -> Column:
    """'normal' when value >= threshold, else 'inverse'; NULL stays NULL."""
    v = _c(c)
    return F.when(v.isNull(), F.lit(None).cast("string")) \
        .when(v >= F.lit(threshold), F.lit("normal")).otherwise(F.lit("inverse"))


def iso_utc(ts) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and a +00:00 offset."""
    return F.concat(F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def time_text(ts) -> Column:
    """Timestamp -> 'yyyy-MM-dd HH:mm:ss.SSSSSS' (UTC session), for stable output."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def clock_text(ts=None) -> Column:
    """'HH:mm:ss UTC' of a timestamp (default: the query's current time)."""
    t = F.current_timestamp() if ts is None else _c(ts)
    return F.date_format(t, "HH:mm:ss 'UTC'")
