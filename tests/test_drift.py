"""Drift of values by quantile sketches."""

import random
from datetime import date, timedelta
from statistics import median

from kinbridge.catalog import queries
from kinbridge.plans import drift

START = date(2026, 1, 1)


def sketches(spark, days, loads=1):
    """``days`` maps (tenant, day number) to values; the values are dealt to loads."""
    parts = []
    for load in range(loads):
        rows = [
            (t, START + timedelta(days=d), v)
            for (t, d), values in days.items()
            for v in values[load::loads]
        ]
        frame = spark.createDataFrame(rows, "tenant string, at date, fee decimal(38,18)")
        parts.append(drift.value_sketches(frame, "at", "fee"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def values(rng, centre, n=200):
    from decimal import Decimal

    return [Decimal(round(rng.gauss(centre, 1), 4)).quantize(Decimal("0.0001")) for _ in range(n)]


def test_a_shifted_day_is_found_and_only_that(spark):
    rng = random.Random(1)
    days = {(t, d): values(rng, 5, 800) for t in ("a", "b") for d in range(12)}
    days["a", 9] = values(rng, 6, 800)
    for loads in (1, 3):
        found = drift.drifted_days(sketches(spark, days, loads)).collect()
        assert {(r.tenant, (r.day - START).days) for r in found if r.drifted} == {("a", 9)}
        assert {(r.day - START).days for r in found} == set(range(1, 12))
        assert {r.past_n for r in found if (r.day - START).days >= 7} == {7 * 800}


def test_ranks_stay_within_the_bound_beyond_the_sketch_size(spark):
    rng = random.Random(2)
    days = {("a", d): values(rng, d, 4000) for d in range(3)}
    found = drift.quantile_bands(sketches(spark, days, 4)).collect()
    assert len(found) == 2 * len(drift.QUANTILES)
    for r in found:
        d = (r.day - START).days
        now = days["a", d]
        past = [v for e in range(d) for v in days["a", e]]
        for given, value, q in ((now, r.value, r.q), (past, r.low, r.q - drift.TOLERANCE),
                                (past, r.high, r.q + drift.TOLERANCE)):
            exact = sum(float(v) <= value for v in given) / len(given)
            assert abs(exact - q) <= drift.RANK_ERROR


def test_small_days_are_not_judged_and_gaps_end_the_past(spark):
    rng = random.Random(3)
    days = {("a", 0): values(rng, 5), ("a", 1): values(rng, 9, 10), ("a", 9): values(rng, 9)}
    found = drift.drifted_days(sketches(spark, days)).collect()
    # Day 9 has day 2 to 8 as its past, which are empty.
    assert [((r.day - START).days, r.n, r.drifted) for r in found] == [(1, 10, None)]


def test_exact_within_the_sketch_size(spark):
    rng = random.Random(4)
    days = {("a", d): values(rng, 5, 101) for d in range(2)}
    middle = next(r for r in drift.quantile_bands(sketches(spark, days, 2)).collect()
                  if r.q == 0.5)
    assert middle.value == float(median(days["a", 1]))


def test_no_rows_and_nulls(spark):
    assert drift.drifted_days(sketches(spark, {})).count() == 0
    found = sketches(spark, {("a", 0): [None, None], (None, 0): values(random.Random(5), 1, 3)})
    assert [r.tenant for r in found.collect()] == [None]
    assert drift.drifted_days(found).count() == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_neither_sketches_nor_rows_are_broadcast(spark, folder):
    """Both are small on disk and large in the driver."""
    rng = random.Random(6)
    rows = [("a", START + timedelta(days=d), rng.random()) for d in range(3) for _ in range(20)]
    frame = spark.createDataFrame(rows, "tenant string, day date, value double")
    drift.value_sketches(frame, "day", "value").write.parquet(f"{folder}/sketches")
    frame.write.parquet(f"{folder}/rows")
    stored = spark.read.parquet(f"{folder}/sketches")
    assert "Join" not in plan_of(drift.with_past(stored))
    checked = queries._checked_drift(spark.read.parquet(f"{folder}/rows"), stored)
    assert plan_of(checked).count("Join Inner") == 1
    assert "rightHint=(strategy=broadcast)" in plan_of(checked)
    assert [tuple(r)[1:] for r in checked.orderBy("day").collect()] == [
        (START + timedelta(days=d), 20, 20 * d, True, True) for d in (1, 2)
    ]
