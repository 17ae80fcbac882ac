"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from churnlens.functions.scalars import (  # noqa: F401
    as_of_lit, clean_count, days_since, finite_or_null, iso_string, parse_ts,
    percent_text, risk_level, safe_years, text_present,
)
