"""Column expressions; all of them stay inside the JVM."""

from kinbridge.functions.identity import canonical_id
from kinbridge.functions.parsing import (
    blank_to_null,
    exact_money,
    full_text,
    instant,
    lenient_instant,
    milliseconds,
    short_text,
    utc_date,
)

__all__ = [
    "blank_to_null",
    "canonical_id",
    "exact_money",
    "full_text",
    "instant",
    "lenient_instant",
    "milliseconds",
    "short_text",
    "utc_date",
]
