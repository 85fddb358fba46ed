"""Known results of the two-tenant sample, when a folder with it is at hand.

KINBRIDGE_SAMPLE_DIR names a folder with the four <source>.json files.
"""

import os
from datetime import date
from decimal import Decimal

import pytest

from kinbridge import COMPAT, STRICT
from kinbridge.plans import facts, kpis, quality
from kinbridge.plans.star import plan_star
from kinbridge.sources import sources_from_folder

FOLDER = os.environ.get("KINBRIDGE_SAMPLE_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="needs KINBRIDGE_SAMPLE_DIR")


@pytest.mark.parametrize("sem", [STRICT, COMPAT])
def test_two_tenant_sample(spark, sem):
    star = plan_star(sources_from_folder(spark, FOLDER), sem)
    reasons = quality.rejections_by_reason(star.events).collect()
    assert {(r.rejection_reason, r.rejected_count) for r in reasons} == {
        ("invalid_net_result_usdt", 1),
        ("missing_event_time", 1),
        ("negative_platform_fee_usdt", 1),
    }
    assert star.dim_customer.count() == 15
    assert star.bridge.count() == 29
    activity, sessions = facts.resolved(star.activity, sem), facts.resolved(star.session, sem)
    assert activity.count() == 29 and facts.unresolved(star.activity).count() == 0
    assert sessions.count() == 15 and facts.unresolved(star.session).count() == 0
    assert [tuple(r) for r in kpis.fee_by_tenant(activity).collect()] == [
        ("tenant-01", Decimal("9.93")), ("tenant-02", Decimal("0.35")),
    ]
    daily = [(date(2026, 5, 30), 9), (date(2026, 5, 31), 10), (date(2026, 6, 1), 9)]
    assert [tuple(r) for r in kpis.daily_active_customers(activity).collect()] == daily
    top = [
        (r.canonical_customer_id[:8], r.event_count, r.net_result_usdt)
        for r in kpis.top_customers(activity).collect()
    ]
    assert top == [
        (i, n, Decimal(net))
        for i, n, net in (
            ("937e7fb3", 3, "32.15"),
            ("1a3ad5a6", 2, "44.10"),
            ("67f6be16", 2, "37.15"),
            ("3bc5bc9f", 2, "5.20"),
            ("afed7c7c", 2, "5.20"),
            ("35e5dec2", 2, "4.05"),
            ("6976608b", 2, "3.00"),
            ("0d0419d5", 2, "1.20"),
            ("549088cd", 2, "1.20"),
            ("90a13ab0", 2, "-4.30"),
        )
    ]
