"""Text to exact values.  Failures become NULL, never an error or a float."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinbridge.contracts import MONEY

# Fixed value: ISO-8601 instant, up to microseconds, with Z or a numeric offset.
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(F.btrim(text, F.lit(" \t\n\x0b\f\r")), F.lit(""))


def exact_money(text: Column | str) -> Column:
    return (F.col(text) if isinstance(text, str) else text).try_cast(MONEY)


def instant(text: Column | str) -> Column:
    """Strict parse: a bare date or time of day is not an instant."""
    return F.try_to_timestamp(text, F.lit(ISO_INSTANT))


def lenient_instant(text: Column | str) -> Column:
    return F.try_to_timestamp(text)


#: One letter stands for the text of an instant that is written like this in UTC.
_SHORT = {"s": "yyyy-MM-dd'T'HH:mm:ss'Z'", "m": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}


def _written(ts: Column, form: str) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), form)


def short_text(text: Column, ts: Column) -> Column:
    """A letter for a text that its parsed instant gives back; other texts as they are."""
    letters = [F.when(text == _written(ts, form), F.lit(x)) for x, form in _SHORT.items()]
    return F.coalesce(*letters, text)


def full_text(short: Column, ts: Column) -> Column:
    """Undoes ``short_text``; no text of an instant is a single letter."""
    texts = [F.when(short == F.lit(x), _written(ts, form)) for x, form in _SHORT.items()]
    return F.coalesce(*texts, short)


def milliseconds(ts: Column | str) -> Column:
    """Warehouse precision of timestamps."""
    return F.date_trunc("millisecond", ts)


def utc_date(ts: Column | str) -> Column:
    """Calendar day of an instant; the session zone is pinned to UTC."""
    return F.to_date(ts)
