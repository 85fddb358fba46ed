import random
from decimal import Decimal

import pytest
from cases import EVENT_ROWS, bag, event, frame, session
from pyspark.sql import functions as F

from kinbridge import COMPAT, STRICT
from kinbridge.contracts import MONEY
from kinbridge.plans import validation
from kinbridge.sources import read_ndjson


def reasons(spark, rows, sem=STRICT):
    labelled = validation.label_events(frame(spark, "activity_events", rows), sem)
    return {r.event_id: r.rejection_reason for r in labelled.collect()}


def reason(spark, row, sem=STRICT):
    return next(iter(reasons(spark, [row], sem).values()))


@pytest.mark.parametrize("sem", [STRICT, COMPAT])
@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (event(None, "A"), "missing_event_id"),
        (event("E", None), "missing_app_customer_id"),
        (event("E", "A", tenant=None), "missing_tenant"),
        (event("E", "A", at=None), "missing_event_time"),
        (event("E", "A", net="-3.7X"), "invalid_net_result_usdt"),
        (event("E", "A", net=None), "invalid_net_result_usdt"),
        (event("E", "A", net="100000000000000000000"), "invalid_net_result_usdt"),
        (event("E", "A", fee="n/a"), "invalid_platform_fee_usdt"),
        (event("E", "A", fee="-0.000000000000000001"), "negative_platform_fee_usdt"),
        (event("E", "A", fee="0"), None),
        (event("E", "A", net="0E-18"), None),
    ],
)
def test_event_rules(spark, row, expected, sem):
    assert reason(spark, row, sem) == expected


@pytest.mark.parametrize("sem", [STRICT, COMPAT])
@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (session(None, "P"), "missing_session_id"),
        (session("S", None), "missing_pam_customer_id"),
        (session("S", "P", login="never"), "invalid_login_at"),
        (session("S", "P", login=None), "invalid_login_at"),
        (session("S", "P", logout="never"), "invalid_logout_at"),
        (session("S", "P", logout=None), "invalid_logout_at"),
        (session("S", "P", logout="2026-01-10T08:59:59Z"), "logout_before_login"),
        (session("S", "P", logout="2026-01-10T09:00:00Z"), None),
    ],
)
def test_session_rules(spark, row, expected, sem):
    labelled = validation.label_sessions(frame(spark, "customer_sessions", [row]), sem)
    assert labelled.first().rejection_reason == expected


def test_first_broken_rule_wins(spark):
    assert reason(spark, event(None, None, net="x", fee="-1")) == "missing_event_id"
    assert reason(spark, event("E", "A", net="x", fee="-1")) == "invalid_net_result_usdt"


def test_unparseable_event_time(spark):
    row = event("E", "A", at="soon")
    assert reason(spark, row) == "invalid_event_time"
    assert reason(spark, row, COMPAT) is None


def test_time_of_day_alone_is_no_instant(spark):
    assert reason(spark, event("E", "A", at="12:00:00")) == "invalid_event_time"


def test_blank_ids(spark):
    assert reason(spark, event("  ", "A")) == "missing_event_id"
    assert reason(spark, event("  ", "A"), COMPAT) is None


def test_separator_in_tenant(spark):
    assert reason(spark, event("E", "A", tenant="a:b")) == "invalid_tenant"
    assert reason(spark, event("E", "A", tenant="a:b"), COMPAT) is None


def test_valid_and_rejected_partition_the_input(spark):
    labelled = validation.label_events(frame(spark, "activity_events", EVENT_ROWS))
    good, bad = validation.accepted(labelled).count(), validation.rejected(labelled).count()
    assert (good, bad) == (6, 3)


def test_public_pair_has_the_documented_shape(spark):
    valid, rejected = validation.validate_activity_events(
        frame(spark, "activity_events", EVENT_ROWS)
    )
    assert dict(valid.dtypes)["net_result_usdt"] == MONEY
    assert valid.columns == [
        "event_id", "app_customer_id", "tenant", "event_type", "event_time",
        "net_result_usdt", "platform_fee_usdt",
    ]
    assert rejected.columns[-3:] == [
        "net_result_decimal", "platform_fee_decimal", "rejection_reason",
    ]
    assert valid.count() == 5
    sessions = validation.validate_sessions(frame(spark, "customer_sessions", [session("S", "P")]))
    assert sessions.valid.columns == [
        "session_id", "pam_customer_id", "login_at", "logout_at", "device", "ip_region",
    ]


def test_survivor_does_not_depend_on_input_order(spark):
    repeats = [
        event("E", "A", "2026-01-10T10:00:00Z", fee="2"),
        event("E", "A", "2026-01-10T10:00:00Z", fee="1"),
        event("E", "A", "2026-01-10T11:00:00Z", fee="0.5"),
    ]
    seen = set()
    for seed in range(4):
        rows = random.Random(seed).sample(repeats, len(repeats))
        df = frame(spark, "activity_events", rows).repartition(3)
        (row,) = validation.validate_activity_events(df).valid.collect()
        seen.add((row.event_time, row.platform_fee_usdt))
    assert seen == {("2026-01-10T10:00:00Z", Decimal(1))}


def test_same_event_id_of_two_accounts_is_two_events(spark):
    rows = [event("E", "A"), event("E", "B")]
    assert validation.validate_activity_events(frame(spark, "activity_events", rows)).valid.count() == 2


def write_lines(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    return folder


LINES = [
    '{"event_id":"E1","app_customer_id":"A","tenant":"t","event_time":"2026-01-01T00:00:00Z",'
    '"event_type":"live","net_result_usdt":1.50,"platform_fee_usdt":"0.1"}',
    "",
    "this is not json",
    '{"event_id":"E2","app_customer_id":"A"',
    '{"event_id":"E3","app_customer_id":"A","tenant":"t","unknown":1}',
]


def test_ndjson_lines(spark, folder):
    raw = read_ndjson(spark, write_lines(spark, folder, LINES), "activity_events")
    found = validation.label_events(raw).groupBy("rejection_reason").count().collect()
    assert {r["rejection_reason"]: r["count"] for r in found} == {
        None: 1, "malformed_record": 2, "missing_event_time": 1,
    }
    kept = {r.net_result_usdt for r in raw.collect()}
    assert "1.50" in kept  # a number keeps its text


def test_ndjson_in_compat_reports_missing_id(spark, folder):
    raw = read_ndjson(spark, write_lines(spark, folder, LINES), "activity_events")
    found = validation.label_events(raw, COMPAT).groupBy("rejection_reason").count().collect()
    assert {r["rejection_reason"]: r["count"] for r in found} == {
        None: 1, "missing_event_id": 2, "missing_event_time": 1,
    }


def test_fee_limit_is_the_last_rule(spark):
    limits = spark.createDataFrame([("t1", Decimal(1))], f"tenant string, max_platform_fee {MONEY}")
    rows = [event("E1", "A", fee="5"), event("E2", "A", fee="1"), event("E3", "A", fee="x"),
            event("E4", "A", fee="5", tenant="t2")]
    labelled = validation.over_fee_limit(
        validation.label_events(frame(spark, "activity_events", rows)), limits
    )
    assert {r.event_id: r.rejection_reason for r in labelled.collect()} == {
        "E1": "platform_fee_over_limit", "E2": None, "E3": "invalid_platform_fee_usdt", "E4": None,
    }


def test_duplicating_the_input_changes_nothing(spark):
    once = frame(spark, "activity_events", EVENT_ROWS)
    twice = once.union(once).orderBy(F.rand(3))
    assert bag(validation.validate_activity_events(once).valid) == bag(
        validation.validate_activity_events(twice).valid
    )
