from datetime import date, datetime

import pytest
from cases import APP_ROWS, EVENT_ROWS, PAM_ROWS, app, bag, event, frame, pam, session, world
from pyspark.sql import functions as F

from kinbridge import COMPAT, STRICT
from kinbridge.contracts import BRIDGE, DIM_CUSTOMER, FACT_ACTIVITY, FACT_SESSION, WAREHOUSE
from kinbridge.plans import facts, incremental, kpis
from kinbridge.plans.run import QUARANTINE, run
from kinbridge.plans.star import plan_star
from kinbridge.plans.validation import label_events, rejected
from kinbridge.sinks import quarantine, warehouse

FIRST, SECOND = datetime(2026, 2, 1), datetime(2026, 2, 2)


def current(spark, root):
    return {
        name: bag(warehouse.read_current(spark, root, c).drop(c.version))
        for name, c in WAREHOUSE.items()
    }


def test_run_loads_the_star(spark, folder):
    report = run(spark, world(spark), folder, loaded_at=FIRST)
    assert report.rows == {"activity_events": 9, "customer_sessions": 4}
    assert report.rejected == {"activity_events": 3, "customer_sessions": 0}
    counts = {r.table_name: r.row_count for r in warehouse.row_counts(spark, folder).collect()}
    assert counts == {
        "dim_customer": 5, "bridge_customer_identity": 9,
        "fact_activity_event": 5, "fact_customer_session": 4,
    }
    star = plan_star(world(spark))
    assert current(spark, folder)["fact_activity_event"] == bag(facts.resolved(star.activity))
    held = quarantine.read(spark, f"{folder}/{QUARANTINE}").collect()
    assert {(r.source, r.rejection_reason, r.copies) for r in held} == {
        ("activity_events", "invalid_net_result_usdt", 1),
        ("activity_events", "missing_event_time", 1),
        ("activity_events", "negative_platform_fee_usdt", 1),
    }


@pytest.mark.parametrize("only_new", [True, False])
def test_rerun_changes_nothing(spark, folder, only_new):
    run(spark, world(spark), folder, loaded_at=FIRST, only_new=only_new)
    once = current(spark, folder)
    run(spark, world(spark), folder, loaded_at=SECOND, only_new=only_new)
    assert current(spark, folder) == once
    stored = warehouse.read_versions(spark, folder, FACT_ACTIVITY).count()
    assert stored == (5 if only_new else 10)
    assert quarantine.read(spark, f"{folder}/{QUARANTINE}").count() == 3


def test_two_batches_equal_one(spark, folder):
    run(spark, world(spark), f"{folder}/whole", loaded_at=FIRST)
    half = len(EVENT_ROWS) // 2
    for part, stamp in ((EVENT_ROWS[half:], FIRST), (EVENT_ROWS[:half], SECOND)):
        run(spark, world(spark, events=part), f"{folder}/parts", loaded_at=stamp)
    assert current(spark, f"{folder}/parts") == current(spark, f"{folder}/whole")


def test_held_facts_are_loaded_once_their_customer_is_known(spark, folder):
    events = [event("E1", "A1"), event("E7", "A7")]
    sessions = [session("S1", "P1"), session("S7", "P7")]
    run(spark, world(spark, events=events, sessions=sessions), folder, loaded_at=FIRST)
    assert warehouse.read_current(spark, folder, FACT_ACTIVITY).count() == 1
    late = world(
        spark, events=[], sessions=[],
        pams=[*PAM_ROWS, pam("P7", "t1", "Gil", "gil")],
        apps=[*APP_ROWS, app("A7", "gil7", "gil")],
    )
    run(spark, late, folder, loaded_at=SECOND)
    assert {r.event_id for r in warehouse.read_current(spark, folder, FACT_ACTIVITY).collect()} == {
        "E1", "E7",
    }
    assert {
        r.session_id for r in warehouse.read_current(spark, folder, FACT_SESSION).collect()
    } == {"S1", "S7"}
    before = current(spark, folder)
    run(spark, late, folder, loaded_at=SECOND)
    assert current(spark, folder) == before


def test_compat_run(spark, folder):
    run(spark, world(spark), folder, COMPAT, loaded_at=FIRST)
    run(spark, world(spark), f"{folder}-strict", loaded_at=FIRST)
    assert current(spark, folder) == current(spark, f"{folder}-strict")


def test_historic_key_keeps_a_session_per_tenant(spark, folder):
    rows = facts.resolved(
        plan_star(
            world(
                spark,
                pams=[pam("P1", "t1", "Ada", "ada"), pam("P1", "t2", "Ada", "ada")],
                sessions=[session("S1", "P1")],
            ),
            COMPAT,
        ).session,
        COMPAT,
    )
    warehouse.create_tables(spark, folder)
    warehouse.append(rows, folder, FACT_SESSION, FIRST)
    for sem, count in ((COMPAT, 2), (STRICT, 1)):
        counts = {r.table_name: r.row_count for r in warehouse.row_counts(spark, folder, sem).collect()}
        assert counts["fact_customer_session"] == count
        warehouse.register_views(spark, folder, sem)
        assert spark.table("fact_customer_session").count() == count


def activity(spark, **kwargs):
    return facts.resolved(plan_star(world(spark, **kwargs)).activity)


def test_latest_version_wins(spark, folder):
    rows = activity(spark)
    warehouse.append(rows.withColumn("event_type", F.lit("old")), folder, FACT_ACTIVITY, FIRST)
    warehouse.append(rows, folder, FACT_ACTIVITY, SECOND)
    assert warehouse.read_versions(spark, folder, FACT_ACTIVITY).count() == 10
    got = warehouse.read_current(spark, folder, FACT_ACTIVITY).drop("loaded_at")
    assert bag(got) == bag(rows)


def test_late_identity_fix_replaces_by_natural_key(spark, folder):
    rows = activity(spark)
    warehouse.append(rows, folder, FACT_ACTIVITY, FIRST)
    star = plan_star(world(spark))
    bridge = star.bridge.withColumn(
        "canonical_customer_id",
        F.when(F.col("source_customer_id") == "A1", F.lit("fixed")).otherwise(
            F.col("canonical_customer_id")
        ),
    )
    moved = incremental.reidentified(rows, bridge)
    assert {r.event_id for r in moved.collect()} == {"E1", "E2"}
    warehouse.append(moved, folder, FACT_ACTIVITY, SECOND)
    natural = warehouse.read_current(spark, folder, FACT_ACTIVITY)
    assert natural.count() == 5
    assert natural.where("canonical_customer_id = 'fixed'").count() == 2
    wide = warehouse.read_current(spark, folder, FACT_ACTIVITY, by_natural_key=False)
    assert wide.count() == 7  # historic key keeps both versions


def test_month_partitions_are_pruned(spark, folder):
    rows = activity(
        spark,
        events=[event("E1", "A1", "2026-01-10T00:00:00Z"), event("E2", "A1", "2026-02-10T00:00:00Z")],
    )
    warehouse.append(rows, folder, FACT_ACTIVITY, FIRST)
    january = warehouse.read_current(spark, folder, FACT_ACTIVITY, months=("202601", "202601"))
    assert [r.event_date for r in january.collect()] == [date(2026, 1, 10)]
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan
    warehouse.create_tables(spark, folder, [DIM_CUSTOMER])
    with pytest.raises(ValueError):
        warehouse.read_versions(spark, folder, DIM_CUSTOMER, months=("202601", "202601"))


def test_compaction_keeps_current_rows_only(spark, folder):
    rows = activity(spark)
    for stamp in (FIRST, SECOND):
        warehouse.append(rows, folder, FACT_ACTIVITY, stamp)
    copy = warehouse.compact(spark, folder, FACT_ACTIVITY)
    stored = warehouse.read_versions(spark, folder, FACT_ACTIVITY)
    assert stored.count() == 5
    assert bag(stored.drop("loaded_at", "ym")) == bag(rows)
    assert spark.read.parquet(copy).count() == 5
    dim = plan_star(world(spark)).dim_customer
    for stamp in (FIRST, SECOND):
        warehouse.append(dim, folder, DIM_CUSTOMER, stamp)
    warehouse.compact(spark, folder, DIM_CUSTOMER)
    assert bag(warehouse.read_versions(spark, folder, DIM_CUSTOMER).drop("updated_at")) == bag(dim)


def test_refresh_replaces_only_the_months_given(spark, folder):
    rows = activity(
        spark,
        events=[event("E1", "A1", "2026-01-10T00:00:00Z"), event("E2", "A1", "2026-02-10T00:00:00Z")],
    )
    warehouse.append(rows, folder, FACT_ACTIVITY, FIRST)
    fixed = rows.where("event_id = 'E2'").withColumn("event_type", F.lit("fixed"))
    for _ in range(2):
        warehouse.refresh_partitions(fixed, folder, FACT_ACTIVITY, SECOND)
    stored = warehouse.read_versions(spark, folder, FACT_ACTIVITY).collect()
    assert {(r.event_id, r.event_type) for r in stored} == {("E1", "slots"), ("E2", "fixed")}


def test_tables_follow_their_contract(spark, folder):
    run(spark, world(spark), folder, loaded_at=FIRST)
    for contract in WAREHOUSE.values():
        stored = warehouse.read_current(spark, folder, contract)
        assert [(f.name, f.dataType) for f in stored.schema] == [
            (f.name, f.dataType) for f in contract.schema
        ]
        assert warehouse.contract_violations(stored, contract).count() == 0
    unresolved = plan_star(world(spark, events=[event("E1", "ghost")]), COMPAT).activity
    found = warehouse.contract_violations(unresolved, FACT_ACTIVITY).collect()
    assert [(r.column_name, r.null_rows) for r in found] == [("canonical_customer_id", 1)]


def test_sql_on_views(spark, folder):
    run(spark, world(spark), folder, loaded_at=FIRST)
    warehouse.register_views(spark, folder)
    got = spark.sql(
        "SELECT tenant, sum(platform_fee_usdt) AS total_platform_fee_usdt "
        "FROM fact_activity_event GROUP BY tenant ORDER BY tenant"
    )
    facts_df = warehouse.read_current(spark, folder, FACT_ACTIVITY)
    assert bag(got) == bag(kpis.fee_by_tenant(facts_df))


def test_bridge_is_partitioned_by_system(spark, folder):
    run(spark, world(spark), folder, loaded_at=FIRST)
    app_side = warehouse.read_current(spark, folder, BRIDGE).where("source_system = 'APP'")
    assert app_side.count() == 4
    plan = app_side._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_system" in plan


def test_quarantine_replays_what_was_rejected(spark, folder):
    rows = [event("X1", "A", net="-3.7X"), event("X1", "A", net="-3.7X"), event("X2", "A", at=None)]
    bad = rejected(label_events(frame(spark, "activity_events", rows)))
    quarantine.write(quarantine.as_quarantine(bad, "activity_events", FIRST), folder)
    stored = quarantine.read(spark, folder)
    assert {(r.rejection_reason, r.copies) for r in stored.collect()} == {
        ("invalid_net_result_usdt", 2), ("missing_event_time", 1),
    }
    again = quarantine.replay(stored, "activity_events")
    assert bag(again) == bag(frame(spark, "activity_events", rows).distinct())
    only = quarantine.replay(stored, "activity_events", "missing_event_time")
    assert [r.event_id for r in only.collect()] == ["X2"]
    quarantine.append_new(quarantine.as_quarantine(bad, "activity_events", SECOND), folder)
    assert quarantine.read(spark, folder).count() == 2


def test_exists(spark, folder):
    assert not warehouse.exists(spark, folder)
    warehouse.create_tables(spark, folder)
    warehouse.create_tables(spark, folder)
    assert all(warehouse.exists(spark, warehouse.table_path(folder, c)) for c in WAREHOUSE.values())
