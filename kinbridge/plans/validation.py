"""Typing and labelling of raw rows.

Each source gets its typed columns and ``rejection_reason``, the first rule the
row breaks, in one row-local projection.  The same projection serves batch and
streaming reads.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinbridge.contracts import CORRUPT_COLUMN, OWNER
from kinbridge.functions import (
    blank_to_null,
    exact_money,
    full_text,
    instant,
    lenient_instant,
    short_text,
)
from kinbridge.operators import Rule, first_broken_rule, one_per_key
from kinbridge.options import STRICT, Semantics

REASON = "rejection_reason"
#: Column with the order of repeats, as ``TableContract.rank`` describes it.
RANK = "survivor_rank"

# Reasons and the order in which they apply.
EVENT_RULES = (
    Rule("missing_event_id", "event_id IS NULL"),
    Rule("missing_app_customer_id", "app_customer_id IS NULL"),
    Rule("missing_tenant", "tenant IS NULL"),
    Rule("missing_event_time", "event_time IS NULL"),
    Rule("invalid_net_result_usdt", "net_result_decimal IS NULL"),
    Rule("invalid_platform_fee_usdt", "platform_fee_decimal IS NULL"),
    Rule("negative_platform_fee_usdt", "platform_fee_decimal < 0"),
)
SESSION_RULES = (
    Rule("missing_session_id", "session_id IS NULL"),
    Rule("missing_pam_customer_id", "pam_customer_id IS NULL"),
    Rule("invalid_login_at", "login_at_ts IS NULL"),
    Rule("invalid_logout_at", "logout_at_ts IS NULL"),
    Rule("logout_before_login", "logout_at_ts < login_at_ts"),
)

# Rules the strict semantics add.
CORRUPT_LINE = Rule("malformed_record", f"{CORRUPT_COLUMN} IS NOT NULL")
WRONG_TENANT = Rule("wrong_tenant", f"tenant <> {OWNER}")
BAD_TENANT = Rule("invalid_tenant", "contains(tenant, ':')")
BAD_EVENT_TIME = Rule("invalid_event_time", "event_time_ts IS NULL")
PAM_RULES = (
    Rule("missing_pam_customer_id", "pam_customer_id IS NULL"),
    Rule("missing_tenant", "tenant IS NULL"),
    BAD_TENANT,
    Rule("missing_email_sha256", "email_sha256 IS NULL"),
)
APP_RULES = (
    Rule("missing_app_customer_id", "app_customer_id IS NULL"),
    Rule("missing_tenant", "tenant IS NULL"),
    BAD_TENANT,
    Rule("missing_email_sha256", "email_sha256 IS NULL"),
)

EVENT_KEY = ("event_id", "app_customer_id")
SESSION_KEY = ("session_id",)


class Verdict(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def _insert_after(rules: tuple[Rule, ...], anchor: str, extra: Rule) -> tuple[Rule, ...]:
    at = [r.reason for r in rules].index(anchor) + 1
    return rules[:at] + (extra,) + rules[at:]


def event_rules(sem: Semantics = STRICT) -> tuple[Rule, ...]:
    rules = EVENT_RULES
    if sem.forbid_separator_in_tenant:
        rules = _insert_after(rules, "missing_tenant", BAD_TENANT)
    if sem.event_time_must_parse:
        rules = _insert_after(rules, "missing_event_time", BAD_EVENT_TIME)
    return rules


def _cleaned(df: DataFrame, sem: Semantics) -> DataFrame:
    if not sem.blank_is_missing:
        return df
    # Only the sources' text is cleaned; columns that merely travel along are not.
    return df.select(
        *(
            blank_to_null(c).alias(c) if kind == "string" and c != CORRUPT_COLUMN else c
            for c, kind in df.dtypes
        )
    )


def _label(df: DataFrame, rules: tuple[Rule, ...], sem: Semantics) -> DataFrame:
    if CORRUPT_COLUMN in df.columns:
        if sem.label_corrupt_lines:
            rules = (CORRUPT_LINE, *rules)
        else:
            df = df.drop(CORRUPT_COLUMN)
    if OWNER in df.columns:
        rules = (*rules, WRONG_TENANT)
    # As the output of a generator the reason cannot be pushed down as a filter.
    # Otherwise the optimizer evaluates everything the rules read twice: once
    # in the pushed filter and once for the rows that pass.
    return df.withColumn(REASON, F.explode(F.array(first_broken_rule(rules))))


def _instant(sem: Semantics):
    return instant if sem.iso_timestamps_only else lenient_instant


def label_events(raw: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """Adds net_result_decimal, platform_fee_decimal, event_time_ts, rejection_reason."""
    typed = _cleaned(raw, sem).withColumns(
        {
            "net_result_decimal": exact_money("net_result_usdt"),
            "platform_fee_decimal": exact_money("platform_fee_usdt"),
            "event_time_ts": _instant(sem)("event_time"),
        }
    )
    return _label(typed, event_rules(sem), sem)


def label_sessions(raw: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """Adds login_at_ts, logout_at_ts, rejection_reason."""
    parse = _instant(sem)
    typed = _cleaned(raw, sem).withColumns(
        {"login_at_ts": parse("login_at"), "logout_at_ts": parse("logout_at")}
    )
    return _label(typed, SESSION_RULES, sem)


def label_pam_customers(raw: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    rules = PAM_RULES if sem.validate_customers else ()
    return _label_customers(_cleaned(raw, sem), "registered_at", rules, sem)


def label_app_customers(enriched: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """Expects the output of ``identity.with_tenants``, which is already clean."""
    rules = APP_RULES if sem.validate_customers else ()
    return _label_customers(enriched, "created_at", rules, sem)


def _label_customers(
    df: DataFrame, since: str, rules: tuple[Rule, ...], sem: Semantics
) -> DataFrame:
    typed = df.withColumn(f"{since}_ts", _instant(sem)(since))
    if not rules:
        return typed.drop(CORRUPT_COLUMN).withColumn(REASON, F.lit(None).cast("string"))
    return _label(typed, rules, sem)


def over_fee_limit(labelled_events: DataFrame, limits: DataFrame) -> DataFrame:
    """Applies the per-tenant fee limit of the manifest as a last rule.

    ``limits`` has one row per tenant of the manifest, so the optimizer
    broadcasts it by its known size.
    """
    bound = limits.withColumnRenamed("tenant", "__tenant")
    joined = labelled_events.join(bound, F.col("tenant") == F.col("__tenant"), "left")
    exceeds = F.col("platform_fee_decimal") > F.col("max_platform_fee")
    reason = F.coalesce(F.col(REASON), F.when(exceeds, F.lit("platform_fee_over_limit")))
    return joined.withColumn(REASON, reason).drop("__tenant", "max_platform_fee")


def accepted(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col(REASON).isNull()).drop(REASON, CORRUPT_COLUMN, OWNER)


def rejected(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col(REASON).isNotNull())


def accepted_events(labelled: DataFrame) -> DataFrame:
    """Accepted rows with money as exact decimals; repeats are still there."""
    return accepted(labelled).select(
        "event_id",
        "app_customer_id",
        "tenant",
        "event_type",
        "event_time",
        F.col("net_result_decimal").alias("net_result_usdt"),
        F.col("platform_fee_decimal").alias("platform_fee_usdt"),
        "event_time_ts",
    )


def unique_events(events: DataFrame) -> DataFrame:
    """One row per natural key: the earliest, then the smallest payload."""
    return one_per_key(events, EVENT_KEY, prefer=["event_time_ts"])


def unique_sessions(sessions: DataFrame) -> DataFrame:
    return one_per_key(sessions, SESSION_KEY, prefer=["login_at_ts", "logout_at_ts"])


def with_short_times(rows: DataFrame, *texts: str) -> DataFrame:
    """Times as short texts, beside the instants that give them back."""
    return rows.withColumns({c: short_text(F.col(c), F.col(f"{c}_ts")) for c in texts})


def _time_text(column: str, short: bool) -> Column:
    return full_text(F.col(column), F.col(f"{column}_ts")).alias(column) if short else F.col(column)


def event_rank(short: bool = False) -> Column:
    """The order of ``unique_events`` as one comparable value; ``short`` is for rows of
    ``with_short_times``."""
    return F.struct(
        F.col("event_time_ts").alias("at"),
        "tenant",
        "event_type",
        _time_text("event_time", short),
        "net_result_usdt",
        "platform_fee_usdt",
    )


def session_rank(short: bool = False) -> Column:
    """The order of ``unique_sessions`` as one comparable value."""
    return F.struct(
        F.col("login_at_ts").alias("login"),
        F.col("logout_at_ts").alias("logout"),
        "pam_customer_id",
        _time_text("login_at", short),
        _time_text("logout_at", short),
        "device",
        "ip_region",
    )


def validate_activity_events(raw: DataFrame, sem: Semantics = STRICT) -> Verdict:
    """Valid events (unique, typed money) and rejected rows with their reason."""
    labelled = label_events(raw, sem)
    valid = unique_events(accepted_events(labelled)).drop("event_time_ts")
    return Verdict(valid, rejected(labelled).drop("event_time_ts"))


def validate_sessions(raw: DataFrame, sem: Semantics = STRICT) -> Verdict:
    """Valid sessions (unique, raw strings) and rejected rows with their reason."""
    labelled = label_sessions(raw, sem)
    valid = unique_sessions(accepted(labelled)).drop("login_at_ts", "logout_at_ts")
    return Verdict(valid, rejected(labelled))
