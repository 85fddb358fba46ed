"""Layout by tenant and day, and readers that open few files."""

from datetime import date, datetime, timedelta

import pytest
from cases import app, bag, event, pam, world

from kinbridge.contracts import FACT_ACTIVITY
from kinbridge.plans.run import run
from kinbridge.sinks import ranges, warehouse

FIRST, SECOND = datetime(2026, 3, 1), datetime(2026, 3, 2)
TENANTS = [f"t{i}" for i in range(6)]


@pytest.fixture(scope="module")
def table(spark):
    """Two months of six tenants, one of them with a third of all rows; 32 files."""
    from kinbridge import workspace

    root = workspace.new_folder(spark, "ranges")
    events = [
        event(f"E{n}", f"A-{t}", (datetime(2026, 1, 5, n % 24) + timedelta(days=n % 50)).isoformat() + "Z",
              tenant=t)
        for i, t in enumerate(TENANTS)
        for n in range(i * 1000, i * 1000 + (250 if t == "t0" else 100))
    ]
    people = dict(
        pams=[pam(f"P-{t}", t, t, t) for t in TENANTS], apps=[app(f"A-{t}", t, t) for t in TENANTS]
    )
    run(spark, world(spark, events=events, sessions=[], **people), root, loaded_at=FIRST)
    before = bag(warehouse.read_current(spark, root, FACT_ACTIVITY))
    ranges.cluster(spark, root, FACT_ACTIVITY, files=32)
    assert bag(warehouse.read_current(spark, root, FACT_ACTIVITY)) == before
    return root, people


def expected(spark, root, first, last, tenant):
    rows = warehouse.read_current(spark, root, FACT_ACTIVITY)
    rows = rows.where(rows.event_date.between(first, last))
    return bag(rows if tenant is None else rows.where(rows.tenant == tenant))


ASKED = [
    (date(2026, 1, 10), date(2026, 1, 10), "t3"),
    (date(2026, 1, 28), date(2026, 2, 3), "t0"),
    (date(2026, 2, 10), date(2026, 2, 11), None),
    (date(2026, 1, 1), date(2026, 12, 31), "t5"),
    (date(2026, 1, 1), date(2026, 12, 31), None),
    (date(2026, 1, 10), date(2026, 1, 10), "nobody"),
    (date(2025, 1, 1), date(2025, 12, 31), "t1"),
    (date(2026, 1, 11), date(2026, 1, 10), "t1"),
]


@pytest.mark.parametrize(("first", "last", "tenant"), ASKED)
def test_same_rows_as_the_whole_table(spark, table, first, last, tenant):
    root, _ = table
    got = bag(ranges.read(spark, root, FACT_ACTIVITY, first, last, tenant))
    assert got == expected(spark, root, first, last, tenant)


def test_a_tenants_day_opens_few_files(spark, table):
    root, _ = table
    every = ranges.files_for(spark, root, FACT_ACTIVITY, date(2026, 1, 1), date(2026, 12, 31))
    assert len(every) >= 24
    for tenant in TENANTS:
        day = date(2026, 1, 20)
        files = ranges.files_for(spark, root, FACT_ACTIVITY, day, day, tenant)
        assert 1 <= len(files) <= len(every) / 6, tenant
        rows = ranges.read(spark, root, FACT_ACTIVITY, day, day, tenant)
        assert len(rows.inputFiles()) == len(files)
    week = ranges.files_for(spark, root, FACT_ACTIVITY, date(2026, 1, 19), date(2026, 1, 20))
    assert len(week) <= len(every) / 2


def test_a_hot_place_is_cut(spark, table):
    """The tenant with a third of the rows does not end up in one file."""
    root, _ = table
    found = ranges.described(spark, root, FACT_ACTIVITY).collect()
    total = sum(r.rows for r in found)
    assert max(r.rows for r in found) <= total / 8


def test_files_without_description_are_read(spark, table):
    """A repeat that wins moves a fact to another day: its new file is not described yet."""
    root, people = table
    moved = event("E1000", "A-t1", "2026-01-02T00:00:00Z", tenant="t1")
    late = event("E9999", "A-t1", "2026-01-20T00:00:00Z", tenant="t1")
    run(spark, world(spark, events=[moved, late], sessions=[], **people), root, loaded_at=SECOND)
    for again in range(2):
        for day in (2, 20):
            at = date(2026, 1, day)
            got = ranges.read(spark, root, FACT_ACTIVITY, at, at, "t1")
            assert bag(got) == expected(spark, root, at, at, "t1")
        whole = ranges.read(spark, root, FACT_ACTIVITY, date(2026, 1, 1), date(2026, 2, 28), "t1")
        days = {r.event_id: r.event_date for r in whole.collect()}
        assert (days["E1000"], days["E9999"]) == (date(2026, 1, 2), date(2026, 1, 20))
        ranges.describe(spark, root, FACT_ACTIVITY)
    names = [r.file for r in ranges.described(spark, root, FACT_ACTIVITY).collect()]
    assert len(names) == len(set(names))


def test_a_table_without_key_index_is_refused(spark, folder):
    warehouse.create_tables(spark, folder)
    with pytest.raises(ValueError, match="no key index"):
        ranges.read(spark, folder, FACT_ACTIVITY, date(2026, 1, 1), date(2026, 1, 2))
