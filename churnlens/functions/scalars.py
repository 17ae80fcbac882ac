"""Scalar (row-level) Column expressions.

Each helper returns a Column built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
DAYS_PER_YEAR = 365.25

# Risk-tier cut points on the unrounded probability.
RISK_TIERS = [(0.30, "LOW"), (0.60, "MEDIUM"), (0.80, "HIGH")]
RISK_TOP = "CRITICAL"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_iso(value) -> str:
    """Normalise a date, datetime or ISO string to ``YYYY-MM-DDTHH:MM:SSZ`` (UTC)."""
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value.strftime("%Y-%m-%dT%H:%M:%SZ")
    if isinstance(value, _dt.date):
        return value.strftime("%Y-%m-%dT00:00:00Z")
    s = str(value).strip().replace(" ", "T")
    if len(s) == 10:
        s += "T00:00:00"
    return s if s.endswith("Z") or "+" in s[10:] else s + "Z"


def as_of_lit(as_of) -> Column:
    """A UTC instant literal; the explicit offset makes it independent of the session time zone."""
    return F.to_timestamp(F.lit(utc_iso(as_of)))


#: What a date string starts with.
DATE_FIRST = r"^\s*\d{4}-\d{2}-\d{2}([T ].*|\s*)$"


def parse_ts(c) -> Column:
    """ISO-8601 parse: a full date (``YYYY-MM-DD``), alone or followed by ``T`` or a blank and a time.

    Junk, empty and null become NULL, and so do a time alone (which would mean today), a
    year alone and dates without leading zeros: one rule for labels and features."""
    x = _c(c)
    return F.when(x.cast("string").rlike(DATE_FIRST), F.try_to_timestamp(x))


ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_string(c) -> Column:
    """Render an instant (TIMESTAMP) as ``YYYY-MM-DDTHH:MM:SSZ`` in UTC, whatever the session zone."""
    return F.date_format(F.to_utc_timestamp(_c(c), F.current_timezone()), ISO_FMT)


def iso_string_naive(c) -> Column:
    """Render a zone-less TIMESTAMP_NTZ (taken as UTC wall-clock time) as an ISO string."""
    return F.date_format(_c(c), ISO_FMT)


def iso_of(df, name: str) -> Column:
    """ISO string of a timestamp column, choosing the rule by its type."""
    from pyspark.sql import types as T
    dt = df.schema[name].dataType
    return iso_string_naive(name) if isinstance(dt, T.TimestampNTZType) else iso_string(name)


def days_since(ts, as_of) -> Column:
    """Whole days from ``ts`` to ``as_of``, floored (a future instant gives -1)."""
    ref = as_of if isinstance(as_of, Column) else as_of_lit(as_of)
    diff = F.unix_micros(ref) - F.unix_micros(_c(ts).cast("timestamp"))
    return F.floor(diff / F.lit(float(MICROS_PER_DAY))).cast("long")


def safe_years(days, min_days: float = 1.0) -> Column:
    """Days → years with the day count floored at ``min_days``; NULL stays NULL."""
    d = _c(days)
    return F.when(d.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(d.cast("double"), F.lit(float(min_days))) / F.lit(DAYS_PER_YEAR))


def clean_count(c) -> Column:
    """Null → 0, negatives clipped to 0, as double."""
    return F.greatest(F.coalesce(_c(c).cast("double"), F.lit(0.0)), F.lit(0.0))


def text_present(c) -> Column:
    """Filled text: not null, not only whitespace, and not the literal ``None``."""
    x = _c(c)
    return (x.isNotNull() & x.rlike(r"[^\s\x1c-\x1f\x85\xa0]") & (x != F.lit("None"))).cast("int")


def finite_or_null(c) -> Column:
    """NaN and ±Infinity become NULL."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def risk_level(p) -> Column:
    """Risk tier from a churn probability (unrounded)."""
    x = _c(p)
    out = F.lit(RISK_TOP)
    for cut, name in reversed(RISK_TIERS):
        out = F.when(x < F.lit(cut), F.lit(name)).otherwise(out)
    return out


def percent_text(p, digits: int = 1, with_sign: bool = True) -> Column:
    """``0.8234`` → ``'82.3%'`` (half-even on the last digit)."""
    num = F.format_number(F.bround(_c(p) * 100, digits), digits)
    return F.concat(num, F.lit("%")) if with_sign else num
