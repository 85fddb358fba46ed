"""A small two-tenant world with every planted case, as literal rows."""

from __future__ import annotations

from hashlib import sha256

from kinbridge.contracts import CORRUPT_COLUMN, SOURCE_COLUMNS, source_schema
from kinbridge.sources import Sources


def email(name: str) -> str:
    return sha256(f"{name}@example.org".encode()).hexdigest()


def person_id(tenant: str, name: str) -> str:
    return sha256(f"{tenant}:{email(name)}".encode()).hexdigest()


def frame(spark, source: str, rows: list[dict], corrupt: bool = False):
    columns = SOURCE_COLUMNS[source] + ((CORRUPT_COLUMN,) if corrupt else ())
    data = [tuple(r.get(c) for c in columns) for r in rows]
    return spark.createDataFrame(data, source_schema(source, keep_corrupt=corrupt))


def pam(pid, tenant, name, who, country="PT", at="2026-01-01T08:00:00Z") -> dict:
    return dict(
        pam_customer_id=pid, tenant=tenant, full_name=name,
        email_sha256=email(who) if who else None, country=country, registered_at=at,
    )


def app(aid, user, who, at="2026-01-02T08:00:00Z") -> dict:
    return dict(
        app_customer_id=aid, username=user, email_sha256=email(who) if who else None, created_at=at
    )


def event(eid, aid, at="2026-01-10T10:00:00Z", net="1.0", fee="0.1", tenant="t1", kind="slots"):
    return dict(
        event_id=eid, app_customer_id=aid, tenant=tenant, event_type=kind, event_time=at,
        net_result_usdt=net, platform_fee_usdt=fee,
    )


def session(sid, pid, login="2026-01-10T09:00:00Z", logout="2026-01-10T09:30:00Z") -> dict:
    return dict(
        session_id=sid, pam_customer_id=pid, login_at=login, logout_at=logout,
        device="web", ip_region="EU",
    )


PAM_ROWS = [
    pam("P1", "t1", "Ada", "ada"),
    pam("P1b", "t1", "Ada", "ada", at="2026-01-03T08:00:00Z"),
    pam("P2", "t1", "Bo", "bo"),
    pam("P3", "t1", "Cy", "cy"),
    pam("P9", "t2", "Zoe", "zoe"),
]
APP_ROWS = [
    app("A1", "ada1", "ada"),
    app("A2", "bo2", "bo"),
    app("A4", "dan4", "dan"),
    app("A9", "zoe9", "zoe"),
]
EVENT_ROWS = [
    event("E1", "A1", "2026-01-10T10:00:00Z", "5", "0.50"),
    event("E2", "A1", "2026-01-09T10:00:00Z", "-2.5", "0.25"),
    event("E3", "A2", "2026-01-10T23:59:59Z", "0E-18", "0.10"),
    event("E3", "A2", "2026-01-10T23:59:59Z", "0E-18", "0.10"),
    event("E4", "A4", "2026-01-11T00:00:00Z", "7", "1"),
    event("E5", "A9", "2026-01-11T12:00:00Z", "3", "0.3", tenant="t2"),
    event("X1", "A1", net="-3.7X"),
    event("X2", "A2", at=None),
    event("X3", "A4", fee="-0.3"),
]
SESSION_ROWS = [
    session("S1", "P1"),
    session("S2", "P1b"),
    session("S3", "P3"),
    session("S4", "P9"),
]


def world(spark, events=None, sessions=None, pams=None, apps=None) -> Sources:
    return Sources(
        frame(spark, "pam_customers", PAM_ROWS if pams is None else pams),
        frame(spark, "app_customers", APP_ROWS if apps is None else apps),
        frame(spark, "activity_events", EVENT_ROWS if events is None else events),
        frame(spark, "customer_sessions", SESSION_ROWS if sessions is None else sessions),
    )


def bag(df) -> list[tuple]:
    """Rows as sorted text, for comparing tables as bags."""
    columns = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in columns) for r in df.select(*columns).collect())
