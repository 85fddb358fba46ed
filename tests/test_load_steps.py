"""Steps of a load: which wait for each other, and how many files they leave."""

from threading import Event

import pytest
from cases import event, session, world

from kinbridge import workspace
from kinbridge.contracts import FACT_ACTIVITY, FACT_SESSION
from kinbridge.plans import run as load
from kinbridge.plans.run import QUARANTINE
from kinbridge.sinks import quarantine, warehouse

ROWS = {
    "events": [event("E1", "A1", "2026-01-10T10:00:00Z"), event("E2", "A1", "soon")],
    "sessions": [
        session("S1", "P1", login="2026-01-11T09:00:00Z", logout="2026-01-20T09:00:00Z"),
        session("S2", "P1", login="later", logout="2026-01-20T09:00:00Z"),
    ],
}


def test_customers_do_not_wait_for_sessions(spark, folder, monkeypatch):
    begun, waited = Event(), []
    tenants, staged = load._tenants, load._stage_labelled

    def tenants_of(*given):
        begun.set()
        return tenants(*given)

    def stage(given, df, source, report):
        if source == "customer_sessions":
            waited.append(begun.wait(60))
        return staged(given, df, source, report)

    monkeypatch.setattr(load, "_tenants", tenants_of)
    monkeypatch.setattr(load, "_stage_labelled", stage)
    report = load.run(spark, world(spark, **ROWS), folder)
    assert waited == [True]
    assert report.rows == {"activity_events": 2, "customer_sessions": 2}
    assert report.rejected == {"activity_events": 1, "customer_sessions": 1}
    held = quarantine.read(spark, f"{folder}/{QUARANTINE}").collect()
    assert sorted(r["source"] for r in held) == ["activity_events", "customer_sessions"]
    for contract in (FACT_ACTIVITY, FACT_SESSION):
        assert warehouse.read_current(spark, folder, contract).count() == 1


@pytest.mark.parametrize(("mb", "most"), [(1, 1), (40, 1), (100, 2), (218, 4), (6400, 100)])
def test_tables_are_laid_out_by_few_tasks(spark, folder, monkeypatch, mb, most):
    """Every task opens a file in each month and bucket, so small ones do not pay."""
    monkeypatch.setattr(workspace, "bytes_below", lambda *_: mb << 20)
    tasks = warehouse.tasks_for(spark, folder)
    assert mb / 64 <= tasks <= most
