from datetime import datetime

import pytest
from cases import EVENT_ROWS, bag, event, frame, world
from pyspark.sql import functions as F

from kinbridge import streaming
from kinbridge.contracts import BRIDGE, FACT_ACTIVITY
from kinbridge.operators import latest_version
from kinbridge.plans import facts, kpis, validation
from kinbridge.plans.star import plan_star
from kinbridge.sinks import keys, merge, quarantine, warehouse

STAMP = datetime(2026, 2, 1)


def arrive(spark, folder, rows):
    """One NDJSON file per call."""
    frame(spark, "activity_events", rows).coalesce(1).write.mode("append").json(f"{folder}/in")


def stream(spark, folder, **options):
    return streaming.label_stream(streaming.read_events(spark, f"{folder}/in", options=options))


def process(spark, folder, df, mode="append"):
    query = streaming.run_available(
        streaming.write_batches(df, f"{folder}/out", f"{folder}/checkpoint", mode)
    )
    return query


def test_labels_equal_batch(spark, folder):
    arrive(spark, folder, EVENT_ROWS)
    process(spark, folder, stream(spark, folder))
    batch = validation.label_events(frame(spark, "activity_events", EVENT_ROWS))
    got = streaming.read_batches(spark, f"{folder}/out").drop("_corrupt_record")
    assert bag(got) == bag(batch)


def test_repeats_across_batches_are_dropped(spark, folder):
    for rows in (EVENT_ROWS, list(reversed(EVENT_ROWS))):
        arrive(spark, folder, rows)
        process(spark, folder, streaming.unique_in_stream(stream(spark, folder), "3 days"))
    got = streaming.read_batches(spark, f"{folder}/out").drop("event_time_ts")
    valid = validation.validate_activity_events(frame(spark, "activity_events", EVENT_ROWS)).valid
    assert bag(got) == bag(valid)


def test_late_rows_are_counted(spark, folder):
    arrive(spark, folder, [event("E1", "A", "2026-01-10T00:00:00Z")])
    unique = lambda: streaming.unique_in_stream(stream(spark, folder), "1 day")
    assert streaming.late_rows(process(spark, folder, unique())) == 0
    arrive(
        spark, folder,
        [event("E2", "A", "2026-01-01T00:00:00Z"), event("E3", "A", "2026-01-09T12:00:00Z"),
         event("E4", "A", None)],
    )
    assert streaming.late_rows(process(spark, folder, unique())) == 1
    got = streaming.read_batches(spark, f"{folder}/out")
    assert {r.event_id for r in got.collect()} == {"E1", "E3"}


def test_enrichment_equals_batch(spark, folder):
    star = plan_star(world(spark))
    arrive(spark, folder, EVENT_ROWS)
    unique = streaming.unique_in_stream(stream(spark, folder))
    process(spark, folder, streaming.with_customers(unique, star.bridge))
    assert bag(streaming.read_batches(spark, f"{folder}/out")) == bag(star.activity)


def test_warehouse_load_survives_a_full_replay(spark, folder):
    star = plan_star(world(spark))
    warehouse.create_tables(spark, folder, [FACT_ACTIVITY])
    warehouse.append(star.bridge, folder, BRIDGE, STAMP)
    for rows in (EVENT_ROWS[:5], EVENT_ROWS[4:]):  # one row comes twice
        arrive(spark, folder, rows)
    for attempt in "ab":  # a lost checkpoint means everything comes again
        labelled = stream(spark, folder, maxFilesPerTrigger="1")
        streaming.run_available(
            streaming.load_warehouse(
                labelled, folder, f"{folder}/quarantine", f"{folder}/checkpoint-{attempt}"
            )
        )
    stored = warehouse.read_versions(spark, folder, FACT_ACTIVITY).drop("loaded_at", "ym")
    assert bag(stored) == bag(facts.resolved(star.activity))
    bad = quarantine.read(spark, f"{folder}/quarantine")
    assert bad.agg(F.sum("copies")).first()[0] == 3


def test_unknown_accounts_wait_in_quarantine(spark, folder):
    warehouse.create_tables(spark, folder, [FACT_ACTIVITY])
    warehouse.append(plan_star(world(spark)).bridge, folder, BRIDGE, STAMP)
    arrive(spark, folder, [event("E1", "A1"), event("E2", "ghost")])
    streaming.run_available(
        streaming.load_warehouse(
            stream(spark, folder), folder, f"{folder}/quarantine", f"{folder}/checkpoint"
        )
    )
    held = quarantine.read(spark, f"{folder}/quarantine").collect()
    assert [(r.rejection_reason, r.copies) for r in held] == [("unresolved_identity", 1)]


def test_daily_fee_follows_updates(spark, folder):
    for rows in (EVENT_ROWS[:5], EVENT_ROWS[5:]):
        arrive(spark, folder, rows)
        events = validation.accepted_events(stream(spark, folder))
        process(spark, folder, streaming.daily_fee(events, "10 days"), "update")
    totals = spark.read.parquet(f"{folder}/out")
    got = latest_version(totals, ["event_date", "tenant"], "batch_id").drop("batch_id")
    events = validation.accepted_events(
        validation.label_events(frame(spark, "activity_events", EVENT_ROWS))
    )
    want = events.groupBy(F.to_date("event_time_ts").alias("event_date"), "tenant").agg(
        F.sum("platform_fee_usdt").cast("decimal(38,18)").alias("total_platform_fee_usdt")
    )
    assert bag(got) == bag(want)


def test_daily_active_customers(spark, folder):
    star = plan_star(world(spark))
    arrive(spark, folder, EVENT_ROWS)
    enriched = streaming.with_customers(
        validation.accepted_events(stream(spark, folder)), star.bridge
    )
    process(spark, folder, streaming.active_customer_days(enriched))
    days = streaming.read_batches(spark, f"{folder}/out")
    got = days.groupBy("event_date").agg(
        F.count_distinct("canonical_customer_id").alias("daily_active_customers")
    )
    assert bag(got) == bag(kpis.daily_active_customers(star.activity))


def test_late_rows_of_many_batches_are_all_counted(spark, folder):
    arrive(spark, folder, [event("E1", "A", "2026-01-10T00:00:00Z")])
    late = streaming.LateRows()
    unique = lambda: streaming.unique_in_stream(
        stream(spark, folder, maxFilesPerTrigger="1"), "1 day"
    ).coalesce(1)
    writer = lambda: streaming.write_batches(
        unique(), f"{folder}/out", f"{folder}/checkpoint"
    )
    streaming.run_available(writer(), late=late)
    old = [event(f"L{i}", "A", "2026-01-01T00:00:00Z") for i in range(4)]
    arrive(spark, folder, old[:2])
    streaming.run_available(writer(), late=late)
    arrive(spark, folder, old[2:])
    streaming.run_available(writer(), late=late)
    assert late.total == 4


def test_stream_and_batch_share_one_quarantine(spark, folder):
    star = plan_star(world(spark))
    warehouse.create_tables(spark, folder, [FACT_ACTIVITY])
    warehouse.append(star.bridge, folder, BRIDGE, STAMP)
    arrive(spark, folder, [event("E1", "ghost"), event(None, "A1")])
    streaming.run_available(
        streaming.load_warehouse(
            stream(spark, folder), folder, f"{folder}/quarantine", f"{folder}/checkpoint"
        )
    )
    more = validation.rejected(
        validation.label_events(frame(spark, "activity_events", [event(None, "A2")]))
    )
    quarantine.append_new(
        quarantine.as_quarantine(more, "activity_events"), f"{folder}/quarantine"
    )
    reasons = quarantine.read(spark, f"{folder}/quarantine").groupBy("rejection_reason").count()
    assert {r[0]: r[1] for r in reasons.collect()} == {
        "unresolved_identity": 1, "missing_event_id": 2,
    }


def test_late_rows_are_set_aside_with_their_payload(spark, folder):
    def split():
        writer = streaming.set_late_aside(
            stream(spark, folder), f"{folder}/split", f"{folder}/quarantine", f"{folder}/checkpoint"
        )
        streaming.run_available(writer)

    batches = [
        [event("E1", "A", "2026-01-10T00:00:00Z"), event("X", "A", net="x")],
        [event("E2", "A", "2026-01-01T00:00:00Z"), event("E3", "A", "2026-01-09T12:00:00Z")],
        [event("E4", "A", "2026-01-08T00:00:00Z"), event("E5", "A", "2026-01-20T00:00:00Z")],
        [event("E6", "A", "2026-01-18T00:00:00Z"), event("E6", "A", "2026-01-18T00:00:00Z")],
    ]
    for rows in batches:  # each run is a restart from the checkpoint
        arrive(spark, folder, rows)
        split()
    passed = spark.read.parquet(f"{folder}/split/rows/*")
    assert {r.event_id for r in passed.collect()} == {"E1", "E3", "E5"}
    held = quarantine.read(spark, f"{folder}/quarantine").collect()
    assert {(r.rejection_reason, r.copies) for r in held} == {
        ("late_event", 1), ("late_event", 2), ("invalid_net_result_usdt", 1),
    }
    again = quarantine.replay(quarantine.read(spark, f"{folder}/quarantine"), "activity_events", "late_event")
    assert {(r.event_id, r.event_time) for r in again.collect()} == {
        ("E2", "2026-01-01T00:00:00Z"), ("E4", "2026-01-08T00:00:00Z"), ("E6", "2026-01-18T00:00:00Z"),
    }


def test_a_stream_that_dies_in_a_batch_goes_on_by_the_clock(spark, folder, monkeypatch):
    star = plan_star(world(spark))
    warehouse.create_tables(spark, folder, [FACT_ACTIVITY])
    warehouse.append(star.bridge, folder, BRIDGE, STAMP)

    def start():
        writer = streaming.load_warehouse(
            stream(spark, folder, maxFilesPerTrigger="1"), folder,
            f"{folder}/quarantine", f"{folder}/checkpoint",
        )
        return streaming.run_continuously(writer, every="1 second")

    commit, calls = merge.commit, []

    def dies_in_the_second_batch(spark, root, contract, taken):
        calls.append(root)
        if len(calls) == 2:
            with monkeypatch.context() as patch:
                patch.setattr(keys, "add", lambda *_: None)
                commit(spark, root, contract, taken)  # rows, but no index entries
            raise RuntimeError("died")
        commit(spark, root, contract, taken)

    for rows in (EVENT_ROWS[:3], EVENT_ROWS[3:6], EVENT_ROWS[6:]):
        arrive(spark, folder, rows)
    with monkeypatch.context() as patch:
        patch.setattr(merge, "commit", dies_in_the_second_batch)
        running = start()
        with pytest.raises(Exception, match="died"):
            running.processAllAvailable()
    running = start()
    running.processAllAvailable()
    running.stop()
    stored = warehouse.read_current(spark, folder, FACT_ACTIVITY).drop("loaded_at")
    assert bag(stored) == bag(facts.resolved(star.activity))
    bad = quarantine.read(spark, f"{folder}/quarantine")
    assert bad.agg(F.sum("copies")).first()[0] == 3


def test_kafka_reader_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streaming.read_events(spark, "broker:9092", source="kafka")
