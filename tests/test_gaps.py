import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kinbridge.operators import activity_sessions

START = datetime(2026, 1, 1)


def brute_force(events, gap):
    """Sorted runs per key; a pause of exactly ``gap`` seconds still merges."""
    out = set()
    for key in {k for k, _ in events}:
        times = sorted(t for k, t in events if k == key)
        run = [times[0]]
        for t in times[1:]:
            if (t - run[-1]).total_seconds() <= gap:
                run.append(t)
            else:
                out.add((key, run[0], run[-1], len(run)))
                run = [t]
        out.add((key, run[0], run[-1], len(run)))
    return out


def found(spark, events, gap):
    df = spark.createDataFrame(events, "who string, at timestamp_ntz").repartition(3)
    return {
        (r.who, r.s, r.e, r.event_count)
        for r in activity_sessions(df, "who", "at", gap)
        .select(
            "who",
            F.col("session_start").cast("timestamp_ntz").alias("s"),
            F.col("session_end").cast("timestamp_ntz").alias("e"),
            "event_count",
        )
        .collect()
    }


def test_random_runs(spark):
    rng = random.Random(5)
    events = [
        (rng.choice("aaab"), START + timedelta(seconds=rng.randrange(0, 60_000)))
        for _ in range(500)
    ]
    for gap in (60, 200, 1800):
        assert found(spark, events, gap) == brute_force(events, gap)


def test_pause_equal_to_the_gap_merges(spark):
    events = [("a", START), ("a", START + timedelta(seconds=60)),
              ("a", START + timedelta(seconds=120, microseconds=1))]
    assert found(spark, events, 60) == brute_force(events, 60)
    assert len(found(spark, events, 60)) == 2


def test_times_before_1970_and_on_bin_edges(spark):
    early = datetime(1969, 12, 31, 23, 59)
    events = [("a", early + timedelta(seconds=s)) for s in (0, 59, 60, 61, 200, 260)]
    assert found(spark, events, 60) == brute_force(events, 60)


def test_agrees_with_session_window(spark):
    rng = random.Random(9)
    events = [
        (rng.choice("abc"), START + timedelta(seconds=rng.randrange(0, 90_000)))
        for _ in range(400)
    ]
    df = spark.createDataFrame(events, "who string, at timestamp")
    built_in = df.groupBy("who", F.session_window("at", "10 minutes")).count()
    mine = activity_sessions(df, "who", "at", 600)
    assert mine.count() == built_in.count()
    assert {(r.who, r.event_count) for r in mine.collect()} == {
        (r["who"], r["count"]) for r in built_in.collect()
    }
