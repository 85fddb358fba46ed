from datetime import date
from decimal import Decimal

from cases import app, bag, event, pam, person_id, session, world

from kinbridge import COMPAT, STRICT
from kinbridge.plans import facts, kpis, quality
from kinbridge.plans.star import plan_star
from kinbridge.plans.validation import label_events


def test_facts_of_the_small_world(spark):
    star = plan_star(world(spark))
    activity = facts.resolved(star.activity).collect()
    assert {(r.event_id, r.canonical_customer_id) for r in activity} == {
        ("E1", person_id("t1", "ada")),
        ("E2", person_id("t1", "ada")),
        ("E3", person_id("t1", "bo")),
        ("E4", person_id("t1", "dan")),
        ("E5", person_id("t2", "zoe")),
    }
    assert {r.event_id: r.event_date for r in activity}["E3"] == date(2026, 1, 10)
    assert star.activity.columns == [
        "event_id", "app_customer_id", "canonical_customer_id", "tenant", "event_type",
        "event_time", "event_date", "net_result_usdt", "platform_fee_usdt",
    ]
    logins = facts.resolved(star.session)
    assert logins.count() == 4
    assert logins.columns == [
        "session_id", "pam_customer_id", "canonical_customer_id", "tenant", "login_at",
        "logout_at", "session_date", "device", "ip_region",
    ]


def test_unmatched_facts_are_held_back(spark):
    sources = world(
        spark,
        events=[event("E1", "A1"), event("E2", "ghost")],
        sessions=[session("S1", "P1"), session("S2", "ghost")],
    )
    star = plan_star(sources)
    assert facts.resolved(star.activity).count() == 1
    assert [(r.event_id, r.rejection_reason) for r in facts.unresolved(star.activity).collect()] == [
        ("E2", "unresolved_identity")
    ]
    assert [r.session_id for r in facts.unresolved(star.session).collect()] == ["S2"]
    compat = plan_star(sources, COMPAT)
    assert facts.resolved(compat.activity, COMPAT).count() == 2
    assert facts.resolved(compat.session, COMPAT).count() == 2


def test_event_needs_the_account_in_its_own_tenant(spark):
    sources = world(spark, events=[event("E1", "A1"), event("E2", "A1", tenant="t2")], pams=[])
    ids = {r.event_id: r.canonical_customer_id for r in plan_star(sources).activity.collect()}
    assert ids == {"E1": person_id("t1", "ada"), "E2": person_id("t2", "ada")}


def test_pam_id_in_two_tenants(spark):
    sources = world(
        spark,
        pams=[pam("P1", "t1", "Ada", "ada"), pam("P1", "t2", "Ada", "ada")],
        sessions=[session("S1", "P1")],
    )
    strict = plan_star(sources)
    assert facts.resolved(strict.session).count() == 0
    assert facts.unresolved(strict.session).first().rejection_reason == "ambiguous_tenant"
    compat = plan_star(sources, COMPAT)
    assert facts.resolved(compat.session, COMPAT).count() == 2  # the historic duplicate


def test_kpis(spark):
    activity = facts.resolved(plan_star(world(spark)).activity)
    assert [tuple(r) for r in kpis.fee_by_tenant(activity).collect()] == [
        ("t1", Decimal("1.85")), ("t2", Decimal("0.3")),
    ]
    top = kpis.top_customers(activity).collect()
    assert tuple(top[0]) == (person_id("t1", "ada"), 2, Decimal("2.5"))
    assert [r.net_result_usdt for r in top[1:]] == [Decimal(7), Decimal(3), Decimal(0)]
    assert [tuple(r) for r in kpis.daily_active_customers(activity).collect()] == [
        (date(2026, 1, 9), 1), (date(2026, 1, 10), 2), (date(2026, 1, 11), 2),
    ]
    estimate = kpis.daily_active_customers_estimate(activity)
    assert bag(estimate) == bag(kpis.daily_active_customers(activity))


def test_two_accounts_of_one_person_are_one_active_customer(spark):
    sources = world(
        spark,
        apps=[app("A1", "u", "ada"), app("A2", "v", "ada")],
        events=[event("E1", "A1"), event("E2", "A2")],
    )
    activity = facts.resolved(plan_star(sources).activity)
    assert kpis.daily_active_customers(activity).first().daily_active_customers == 1
    assert kpis.top_customers(activity).first().event_count == 2


def test_ties_are_decided_by_id(spark):
    apps = [app(f"A{i}", f"u{i}", f"who{i}") for i in range(12)]
    events = [event(f"E{i}", f"A{i}") for i in range(12)]
    activity = facts.resolved(plan_star(world(spark, apps=apps, events=events, pams=[])).activity)
    top = [r.canonical_customer_id for r in kpis.top_customers(activity.repartition(5)).collect()]
    assert top == sorted(person_id("t1", f"who{i}") for i in range(12))[:10]


def test_null_customers_group_together_in_compat(spark):
    sources = world(spark, events=[event(f"E{i}", "ghost") for i in range(3)])
    activity = facts.resolved(plan_star(sources, COMPAT).activity, COMPAT)
    assert tuple(kpis.top_customers(activity).first())[:2] == (None, 3)
    assert kpis.daily_active_customers(activity).first().daily_active_customers == 0


def test_fees_are_conserved(spark):
    star = plan_star(world(spark))
    every = star.activity.selectExpr("sum(platform_fee_usdt) s").first().s
    kept = facts.resolved(star.activity).selectExpr("sum(platform_fee_usdt) s").first().s
    held = facts.unresolved(star.activity).selectExpr("sum(platform_fee_usdt) s").first().s or 0
    assert every == kept + held


def test_rejection_rates_and_profile(spark):
    raw = world(spark).activity_events
    labelled = label_events(raw, STRICT)
    rates = {
        (r.tenant, r.rejection_reason): (r.rejected_count, r.day_rows)
        for r in quality.rejection_rates(labelled).collect()
    }
    assert rates["t1", "missing_event_time"] == (1, 1)
    assert rates["t1", "invalid_net_result_usdt"] == (1, 5)
    profile = {r.column_name: r for r in quality.column_profile(raw).collect()}
    assert profile["event_time"].null_count == 1
    assert profile["event_id"].min_value == "E1" and profile["event_id"].row_count == 9
