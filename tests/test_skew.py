"""A third of all rows shares one key; results stay whole and tasks stay even."""

from collections import Counter
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from cases import app, email, event, frame, pam, person_id, world
from pyspark.sql import functions as F

from kinbridge import COMPAT
from kinbridge.contracts import FACT_ACTIVITY
from kinbridge.operators import activity_sessions
from kinbridge.plans import facts, identity, kpis, validation
from kinbridge.plans.star import plan_star
from kinbridge.sinks import warehouse

HOT, COLD = 3_000, 6_000


@contextmanager
def settings(spark, **values):
    """Settings for a while; small sizes make adaptive splitting visible."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def small_partitions(size):
    return {
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": size,
        "spark__sql__shuffle__partitions": "16",
    }


def hot_copies(spark):
    """One event repeated for a third of the rows, in ever other payloads."""
    hot = [event("HOT", "A1", fee=f"{1 + i % 7}") for i in range(HOT)]
    cold = [event(f"E{i}", "A2") for i in range(COLD)]
    return frame(spark, "activity_events", hot + cold).repartition(16)


def test_copies_are_reduced_before_the_shuffle(spark):
    labelled = validation.label_events(hot_copies(spark))
    unique = validation.unique_events(validation.accepted_events(labelled))
    plan = unique._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning(event_id") < partial  # below the exchange
    rows = unique.collect()
    assert len(rows) == COLD + 1
    assert [int(r.platform_fee_usdt) for r in rows if r.event_id == "HOT"] == [1]


def test_hot_customer_in_the_fact_join_without_broadcast(spark):
    events = [event(f"H{i}", "A1") for i in range(HOT)]
    events += [event(f"E{i}", f"B{i % 50}") for i in range(COLD)]
    apps = [app("A1", "hot", "hot"), *(app(f"B{i}", f"u{i}", f"who{i}") for i in range(50))]
    no_broadcast = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    }
    with settings(spark, **no_broadcast, **small_partitions("20KB")):
        star = plan_star(world(spark, events=events, apps=apps, pams=[]))
        activity = facts.resolved(star.activity).repartition(7)
        rows = activity.collect()
        plan = activity._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan  # the hot customer's partition was split
    counts = Counter(r.canonical_customer_id for r in rows)
    assert counts[person_id("t1", "hot")] == HOT
    assert sum(counts.values()) == HOT + COLD


@pytest.mark.parametrize("sem_name", ["strict", "compat"])
def test_hot_email_is_never_paired(spark, sem_name):
    """A third of both systems' accounts share one email."""
    n = 2_000
    pams = [pam(f"P{i}", "t1", f"N{i}", "hot") for i in range(n)]
    pams += [pam(f"Q{i}", "t1", f"N{i}", f"who{i}") for i in range(n)]
    apps = [app(f"A{i}", f"u{i}", "hot") for i in range(n)]
    events = [event(f"E{i}", f"A{i}") for i in range(n)]
    kwargs = {} if sem_name == "strict" else {"sem": COMPAT}
    star = plan_star(world(spark, pams=pams, apps=apps, events=events), **kwargs)
    assert star.dim_customer.count() == n + 1
    assert star.bridge.count() == 3 * n
    hot = star.dim_customer.where(F.col("email_sha256") == email("hot")).collect()
    assert [(r.full_name, r.username) for r in hot] == [("N0", "u0")]
    found = identity.persons(star.claims).where(F.col("email_sha256") == email("hot")).first()
    assert (found.pam_accounts, found.app_accounts) == (n, n)


def test_hot_customer_is_folded_before_sessions_are_built(spark):
    start = datetime(2026, 1, 1)
    hot = [("hot", start + timedelta(seconds=i)) for i in range(HOT)]
    hot += [("hot", start + timedelta(days=1, seconds=i)) for i in range(HOT)]
    cold = [(f"c{i % 100}", start + timedelta(hours=i)) for i in range(COLD)]
    df = spark.createDataFrame(hot + cold, "who string, at timestamp").repartition(16)
    sessions = activity_sessions(df, "who", "at", 1800)
    found = sessions.where("who = 'hot'").orderBy("session_start").collect()
    assert [r.event_count for r in found] == [HOT, HOT]
    assert sessions.agg(F.sum("event_count")).first()[0] == 2 * HOT + COLD
    plan = sessions._jdf.queryExecution().executedPlan().toString()
    # Folded by (key, bin) first; only bins are exchanged by key.  The third
    # exchange spreads the test rows.
    assert plan.count("partial_count(1)") == 1
    assert plan.count("Exchange") == 3


def test_hot_month_is_written_by_several_tasks(spark, folder):
    apps = [app(f"A{i}", f"u{i}", f"who{i}") for i in range(100)]
    events = [
        event(f"E{i}", f"A{i % 100}", f"2026-01-{1 + i % 28:02d}T00:00:00Z") for i in range(20_000)
    ]
    events += [event(f"F{i}", "A1", "2026-03-01T00:00:00Z") for i in range(100)]
    sources = world(spark, events=events, apps=apps)
    activity = facts.resolved(plan_star(sources).activity)
    # Rows must come from several tasks for their month to be splittable.
    no_broadcast = {"spark__sql__autoBroadcastJoinThreshold": "-1"}
    with settings(spark, **no_broadcast, **small_partitions("50KB")):
        warehouse.append(activity, folder, FACT_ACTIVITY)
    files = (
        spark.read.parquet(f"{folder}/fact_activity_event")
        .select("ym", F.input_file_name().alias("f"))
        .distinct()
        .groupBy("ym")
        .count()
        .collect()
    )
    per_month = {str(r["ym"]): r["count"] for r in files}
    assert per_month["202601"] > 1
    assert per_month["202603"] == 1
    assert warehouse.read_current(spark, folder, FACT_ACTIVITY).count() == 20_100


def test_kpis_combine_before_the_shuffle(spark):
    activity = facts.resolved(plan_star(world(spark)).activity)
    for kpi in (kpis.fee_by_tenant, kpis.top_customers, kpis.daily_active_customers):
        plan = kpi(activity)._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan
    top = kpis.top_customers(activity)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top
