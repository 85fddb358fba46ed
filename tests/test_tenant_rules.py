"""Rules given as rows, and tenants that own their files."""

import json

import pytest
from cases import APP_ROWS, PAM_ROWS, SESSION_ROWS, event, frame
from test_sources import write_lines

from kinbridge.contracts import FACT_ACTIVITY
from kinbridge.plans import tenant_rules
from kinbridge.plans.run import QUARANTINE, TENANTS, run
from kinbridge.plans.validation import REASON, label_events
from kinbridge.sinks import quarantine, warehouse
from kinbridge.sources import sources_from_manifest
from kinbridge.sources.manifest import RULES, TenantEntry, TenantRule, read_manifest, read_source
from kinbridge.sources.manifest import tenant_rules as rule_table

SOURCE = "activity_events"


def labels(spark, rules, rows):
    """Reason by event id; rules are (tenant, column, kind, bound) in their order."""
    table = spark.createDataFrame(
        [(t, SOURCE, i, c, k, b, f"{k}_{c}") for i, (t, c, k, b) in enumerate(rules)], RULES
    )
    found = tenant_rules.apply(
        label_events(frame(spark, SOURCE, rows)), tenant_rules.checked(table), SOURCE
    )
    assert found.columns == label_events(frame(spark, SOURCE, rows)).columns
    return {r.event_id: r[REASON] for r in found.collect()}


@pytest.mark.parametrize(
    ("column", "kind", "bound", "good", "bad"),
    [
        ("event_type", "required", None, "slots", None),
        ("net_result_usdt", "min", "0.1", "0.10", "0.099999999999999999"),
        ("net_result_usdt", "max", "-1", "-1.0", "-0.999999999999999999"),
        ("event_time", "not_before", "2026-01-10T00:00:00Z", "2026-01-10T00:00:00Z", "2026-01-09T23:59:59.999Z"),
        ("event_time", "not_after", "2026-01-10T00:00:00Z", "2026-01-10T02:00:00+02:00", "2026-01-10T00:00:00.001Z"),
        ("event_type", "matches", "a|b", "b", "ab"),
        ("event_type", "matches", "[a-z]+", "xyz", "xyz\nx"),
        ("event_type", "one_of", "a|b.c", "b.c", "bxc"),
        ("event_type", "max_length", "2", "éé", "abc"),
    ],
)
def test_every_kind(spark, column, kind, bound, good, bad):
    rows = [
        event("good", "A1") | {column: good},
        event("bad", "A1") | {column: bad},
        event("other", "A1", tenant="t2") | {column: bad},
    ]
    found = labels(spark, [("t1", column, kind, bound)], rows)
    assert found == {"good": None, "bad": f"{kind}_{column}", "other": None}


def test_missing_values_break_only_required(spark):
    rules = [("t1", "event_type", k, b) for k, b in
             (("matches", "x"), ("one_of", "x"), ("max_length", "0"), ("required", None))]
    assert labels(spark, rules, [event("E", "A1", kind=None)]) == {"E": "required_event_type"}
    assert labels(spark, rules[:3], [event("E", "A1", kind=None)]) == {"E": None}


def test_first_rule_by_position_and_fixed_rules_first(spark):
    rules = [("t1", "platform_fee_usdt", "max", "1"), ("t1", "event_type", "one_of", "dice")]
    rows = [event("both", "A1", fee="2"), event("second", "A1"), event("fixed", "A1", fee="-2")]
    assert labels(spark, rules, rows) == {
        "both": "max_platform_fee_usdt",
        "second": "one_of_event_type",
        "fixed": "negative_platform_fee_usdt",
    }
    assert labels(spark, rules[::-1], rows)["both"] == "one_of_event_type"


def test_no_rules_and_no_rows(spark):
    assert labels(spark, [], [event("E", "A1")]) == {"E": None}
    assert labels(spark, [("t1", "event_type", "one_of", "x")], []) == {}


@pytest.mark.parametrize(
    ("column", "kind", "bound"),
    [("no_column", "required", None), ("event_type", "odd", "1"), ("event_type", "max", "much"),
     ("event_time", "not_before", "soon"), ("event_type", "one_of", None)],
)
def test_unusable_rules_are_errors(spark, column, kind, bound):
    with pytest.raises(ValueError, match="unusable rule"):
        labels(spark, [("t1", column, kind, bound)], [event("E", "A1")])


def as_lines(rows):
    return [json.dumps({k: v for k, v in r.items() if v is not None}) for r in rows]


def test_own_files_give_and_check_the_tenant(spark, folder):
    base = f"{folder}/a b"
    write_lines(spark, f"{base}/x", as_lines(
        [event("E1", "A1", tenant=None), event("E2", "A1", tenant="t2"), event("E3", "A1", tenant=" ")]
    ))
    write_lines(spark, f"{base}/y", as_lines([event("E4", "A1", tenant="t2")]))
    write_lines(spark, f"{base}/free/z", as_lines([event("E5", "A1", tenant=None)]))
    entries = [
        TenantEntry("t1", {SOURCE: f"{base}/x"}, own_files=True),
        TenantEntry("t2", {SOURCE: f"{base}/y/"}, own_files=True),
        TenantEntry("t3", {SOURCE: f"{base}/free/z"}),
    ]
    raw = read_source(spark, SOURCE, entries)
    found = {r.event_id: (r.tenant, r[REASON]) for r in label_events(raw).collect()}
    assert found == {
        "E1": ("t1", None),
        "E2": ("t2", "wrong_tenant"),
        "E3": ("t1", None),
        "E4": ("t2", None),
        "E5": (None, "missing_tenant"),
    }
    owned = read_source(spark, SOURCE, entries[:2])
    plan = owned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "file_tenant" in owned.columns
    assert "file_tenant" not in read_source(spark, SOURCE, entries[2:]).columns


def test_one_place_has_one_owner(spark, folder):
    write_lines(spark, f"{folder}/x", ["{}"])
    entries = [TenantEntry(t, {SOURCE: f"{folder}/x"}, own_files=True) for t in ("t1", "t2")]
    with pytest.raises(ValueError, match="belongs to t1 and to t2"):
        read_source(spark, SOURCE, entries)


def test_load_by_manifest_with_rules(spark, folder):
    """The wrong tenant is rejected, teaches no account a tenant, and can be replayed."""
    rows = [
        event("E1", "A1", tenant=None),
        event("E2", "A9"),
        event("E3", "A2", tenant="t2"),
        event("E4", "A2", fee="9"),
    ]
    for name, given in (("pam_customers", PAM_ROWS[:4]), ("app_customers", APP_ROWS),
                        (SOURCE, rows), ("customer_sessions", SESSION_ROWS)):
        write_lines(spark, f"{folder}/in/{name}", as_lines(given))
    paths = {n: f"{folder}/in/{n}" for n in ("pam_customers", "app_customers", SOURCE, "customer_sessions")}
    rule = TenantRule(SOURCE, "platform_fee_usdt", "max", "5", "too_dear")
    line = {"tenant": "t1", "paths": paths, "own_files": True, "rules": [rule._asdict()]}
    write_lines(spark, f"{folder}/manifest", [json.dumps(line)])
    entries = read_manifest(spark, f"{folder}/manifest")
    assert entries == [TenantEntry("t1", paths, own_files=True, rules=(rule,))]
    root = f"{folder}/out"
    report = run(
        spark, sources_from_manifest(spark, entries), root, rules=rule_table(spark, entries)
    )
    assert (report.rows[SOURCE], report.rejected[SOURCE]) == (4, 2)
    stored = warehouse.read_current(spark, root, FACT_ACTIVITY)
    assert {(r.event_id, r.tenant) for r in stored.collect()} == {("E1", "t1"), ("E2", "t1")}
    held = quarantine.read(spark, f"{root}/{QUARANTINE}").where(f"source = '{SOURCE}'")
    assert {r[REASON] for r in held.collect()} == {"wrong_tenant", "too_dear"}
    tenants = spark.read.parquet(f"{root}/{TENANTS}")
    assert {r.tenant for r in tenants.collect()} == {"t1"}
