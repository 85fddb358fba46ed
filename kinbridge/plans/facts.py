"""Facts: valid events and sessions with their canonical customer.

The large side keeps its rows; the bridge side is unique per join key, so the
joins never multiply rows.  No broadcast is forced: the optimizer broadcasts the
bridge only when its measured size allows, and otherwise sort-merge joins with
adaptive splitting of a hot customer's partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinbridge.contracts import FACT_ACTIVITY, TableContract
from kinbridge.functions import milliseconds, utc_date
from kinbridge.options import STRICT, Semantics
from kinbridge.plans.identity import APP, PAM
from kinbridge.plans.validation import (
    RANK,
    REASON,
    event_rank,
    session_rank,
    with_short_times,
)

UNRESOLVED = "unresolved_identity"
AMBIGUOUS = "ambiguous_tenant"


def activity_facts(events: DataFrame, bridge: DataFrame, *carried: Column | str) -> DataFrame:
    """Valid unique events with the customer of (app account, tenant), or NULL.

    ``carried`` are made of columns of the events after the join, which need not move them.
    """
    app = bridge.where(F.col("source_system") == APP).select(
        F.col("source_customer_id").alias("app_customer_id"), "tenant", "canonical_customer_id"
    )
    at = milliseconds("event_time_ts")
    return events.join(app, ["app_customer_id", "tenant"], "left").select(
        "event_id",
        "app_customer_id",
        "canonical_customer_id",
        "tenant",
        "event_type",
        at.alias("event_time"),
        utc_date(at).alias("event_date"),
        "net_result_usdt",
        "platform_fee_usdt",
        *_rank_of(events),
        *carried,
    )


def ranked_activity(events: DataFrame, bridge: DataFrame, *carried: Column | str) -> DataFrame:
    """``activity_facts`` with their rank; on the way to it the times are short texts."""
    rank = event_rank(short=True).alias(RANK)
    return activity_facts(with_short_times(events, "event_time"), bridge, rank, *carried)


def _rank_of(rows: DataFrame) -> list[str]:
    """The rank travels along where the rows have one."""
    return [RANK] if RANK in rows.columns else []


def session_facts(
    sessions: DataFrame, bridge: DataFrame, sem: Semantics = STRICT, *carried: Column | str
) -> DataFrame:
    """Valid unique sessions with the customer and tenant of the PAM account.

    A PAM id known in several tenants gives no customer (``one_tenant_per_pam_id``)
    or, historically, one row per tenant.  ``tenant_count`` tells them apart.
    """
    pam = _pam_links(bridge, sem)
    login, logout = milliseconds("login_at_ts"), milliseconds("logout_at_ts")
    return sessions.join(pam, "pam_customer_id", "left").select(
        "session_id",
        "pam_customer_id",
        "canonical_customer_id",
        "tenant",
        login.alias("login_at"),
        logout.alias("logout_at"),
        utc_date(login).alias("session_date"),
        "device",
        "ip_region",
        "tenant_count",
        *_rank_of(sessions),
        *carried,
    )


def ranked_sessions(
    sessions: DataFrame, bridge: DataFrame, sem: Semantics = STRICT, *carried: Column | str
) -> DataFrame:
    """``session_facts`` with their rank, like ``ranked_activity``."""
    short = with_short_times(sessions, "login_at", "logout_at")
    return session_facts(short, bridge, sem, session_rank(short=True).alias(RANK), *carried)


def _pam_links(bridge: DataFrame, sem: Semantics) -> DataFrame:
    """(pam_customer_id, tenant, canonical_customer_id, tenant_count)."""
    pam = bridge.where(F.col("source_system") == PAM).select(
        F.col("source_customer_id").alias("pam_customer_id"), "tenant", "canonical_customer_id"
    )
    if sem.one_tenant_per_pam_id:
        only = F.col("tenant_count") == 1
        pam = (
            pam.groupBy("pam_customer_id")
            .agg(
                F.count(F.lit(1)).alias("tenant_count"),
                F.min("tenant").alias("tenant"),
                F.min("canonical_customer_id").alias("canonical_customer_id"),
            )
            .withColumns(
                {c: F.when(only, F.col(c)) for c in ("tenant", "canonical_customer_id")}
            )
        )
    else:
        pam = pam.withColumn("tenant_count", F.lit(1).cast("bigint"))
    return pam


def relinked(
    stored: DataFrame, contract: TableContract, bridge: DataFrame, sem: Semantics = STRICT
) -> DataFrame:
    """Stored facts with the customer (and, of sessions, the tenant) of another bridge."""
    if contract.name == FACT_ACTIVITY.name:
        app = bridge.where(F.col("source_system") == APP).select(
            F.col("source_customer_id").alias("app_customer_id"), "tenant", "canonical_customer_id"
        )
        found = stored.drop("canonical_customer_id").join(app, ["app_customer_id", "tenant"], "left")
        return found.select(*stored.columns)
    links = _pam_links(bridge, sem)
    found = stored.drop("canonical_customer_id", "tenant").join(links, "pam_customer_id", "left")
    return found.select(*stored.columns, "tenant_count")


def resolved(facts: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """Rows that may enter the fact table."""
    if sem.facts_need_identity:
        facts = facts.where(F.col("canonical_customer_id").isNotNull())
    return facts.drop("tenant_count")


def unresolved(facts: DataFrame) -> DataFrame:
    """Rows held back until an identity turns up, with the reason."""
    reason = F.lit(UNRESOLVED)
    if "tenant_count" in facts.columns:
        reason = F.when(F.col("tenant_count") > 1, F.lit(AMBIGUOUS)).otherwise(reason)
    held = facts.where(F.col("canonical_customer_id").isNull())
    return held.withColumn(REASON, reason).drop("tenant_count")
