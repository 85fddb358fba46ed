from datetime import date, datetime
from decimal import Decimal
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from kinbridge.functions import (
    blank_to_null,
    canonical_id,
    exact_money,
    instant,
    lenient_instant,
    milliseconds,
    utc_date,
)


def evaluate(spark, expression, value):
    frame = spark.createDataFrame([(value,)], "x string")
    return frame.select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("0.450000000000000000", Decimal("0.45")),
        ("0E-18", Decimal(0)),
        (" 1.5 ", Decimal("1.5")),
        ("1e3", Decimal(1000)),
        ("+2", Decimal(2)),
        (".5", Decimal("0.5")),
        ("0.0000000000000000005", Decimal("0.000000000000000001")),
        ("99999999999999999999", Decimal("99999999999999999999")),
        ("100000000000000000000", None),
        ("-3.7X", None),
        ("NaN", None),
        ("", None),
        (None, None),
    ],
)
def test_money_is_exact_or_null(spark, text, value):
    assert evaluate(spark, exact_money, text) == value


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2026-05-30T13:42:07Z", datetime(2026, 5, 30, 13, 42, 7)),
        ("2026-05-30T13:42:07.123456Z", datetime(2026, 5, 30, 13, 42, 7, 123456)),
        ("2026-05-30T13:42:07+02:00", datetime(2026, 5, 30, 11, 42, 7)),
        ("2026-05-30", None),
        ("12:00:00", None),
        ("2026", None),
        ("2026-05-30T25:00:00Z", None),
        ("soon", None),
        (None, None),
    ],
)
def test_strict_instant(spark, text, value):
    got = evaluate(spark, lambda c: instant(c).cast("timestamp_ntz"), text)
    assert got == value


def test_lenient_instant_takes_dates_and_never_fails(spark):
    day = evaluate(spark, lambda c: lenient_instant(c).cast("timestamp_ntz"), "2026-05-30")
    assert day == datetime(2026, 5, 30)
    assert evaluate(spark, lenient_instant, "soon") is None


def test_warehouse_precision_is_milliseconds(spark):
    got = evaluate(
        spark,
        lambda c: milliseconds(instant(c)).cast("timestamp_ntz"),
        "2026-05-30T13:42:07.123456Z",
    )
    assert got == datetime(2026, 5, 30, 13, 42, 7, 123000)


def test_day_is_cut_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    got = evaluate(spark, lambda c: utc_date(instant(c)), "2026-05-31T01:00:00Z")
    assert got == date(2026, 5, 31)


def test_blank_is_null(spark):
    assert evaluate(spark, blank_to_null, "   ") is None
    assert evaluate(spark, blank_to_null, " a ") == "a"


def test_canonical_id_formula(spark):
    row = spark.sql("SELECT 'tenant-01' t, 'abc' e").select(canonical_id("t", "e").alias("i"))
    assert row.first().i == sha256(b"tenant-01:abc").hexdigest()


def test_canonical_id_skips_missing_parts_and_collides_on_separator(spark):
    """Why the strict semantics check both parts first."""
    rows = spark.sql(
        "SELECT * FROM VALUES ('t', NULL), (NULL, 't'), ('a:b', 'c'), ('a', 'b:c') AS v(t, e)"
    ).select(canonical_id("t", "e").alias("i"))
    first, second, third, fourth = (r.i for r in rows.collect())
    assert first == second
    assert third == fourth
