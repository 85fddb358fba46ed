"""Identity quality, data quality and activity listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinbridge.plans.identity import APP, PAM, PERSON, persons
from kinbridge.plans.validation import REASON

ACCOUNT = ("tenant", "source_system", "source_customer_id")


# --- emails --------------------------------------------------------------------


def duplicate_emails(all_claims: DataFrame) -> DataFrame:
    """Emails used by several accounts of one system within a tenant."""
    return (
        all_claims.groupBy(*PERSON, "source_system")
        .agg(F.count_distinct("source_customer_id").alias("account_count"))
        .where("account_count > 1")
    )


def missing_emails(pam_labelled: DataFrame, app_labelled: DataFrame) -> DataFrame:
    """Accounts without an email, per system and tenant."""
    parts = [
        df.select(F.lit(system).alias("source_system"), "tenant", "email_sha256")
        for system, df in ((PAM, pam_labelled), (APP, app_labelled))
    ]
    accounts = parts[0].unionByName(parts[1])
    return (
        accounts.where("email_sha256 IS NULL OR trim(email_sha256) = ''")
        .groupBy("source_system", "tenant")
        .agg(F.count(F.lit(1)).alias("accounts_without_email"))
    )


# --- conflicts --------------------------------------------------------------------


def _contradicts(column: str):
    return F.min(column) != F.max(column)


def conflicting_persons(all_claims: DataFrame) -> DataFrame:
    """Per (tenant, email): do its accounts disagree on name or country?"""
    flags = all_claims.groupBy(*PERSON).agg(
        F.coalesce(_contradicts("full_name"), F.lit(False)).alias("two_names"),
        F.coalesce(_contradicts("country"), F.lit(False)).alias("two_countries"),
    )
    return flags.where("two_names OR two_countries")


def conflicting_accounts(all_claims: DataFrame) -> DataFrame:
    """Accounts that appear with more than one email."""
    return (
        all_claims.groupBy(*ACCOUNT)
        .agg(_contradicts("email_sha256").alias("two_emails"))
        .where("two_emails")
    )


def identity_conflicts(all_claims: DataFrame) -> DataFrame:
    """Review table: (tenant, conflict, subject).  Nothing is merged because of it."""
    labels = F.array_compact(
        F.array(
            F.when(F.col("two_names"), F.lit("email_with_two_names")),
            F.when(F.col("two_countries"), F.lit("email_with_two_countries")),
        )
    )
    by_email = conflicting_persons(all_claims).select(
        "tenant", F.explode(labels).alias("conflict"), F.col("email_sha256").alias("subject")
    )
    by_account = conflicting_accounts(all_claims).select(
        "tenant",
        F.lit("account_with_two_emails").alias("conflict"),
        F.concat_ws(":", "source_system", "source_customer_id").alias("subject"),
    )
    return by_email.unionByName(by_account)


def bridge_with_review(bridge: DataFrame, all_claims: DataFrame) -> DataFrame:
    """The bridge plus ``review_flag`` for identities with a conflict."""
    persons_flag = conflicting_persons(all_claims).select(*PERSON, F.lit(True).alias("__p"))
    accounts_flag = conflicting_accounts(all_claims).select(*ACCOUNT, F.lit(True).alias("__a"))
    flagged = bridge.join(persons_flag, [*PERSON], "left").join(
        accounts_flag, [*ACCOUNT], "left"
    )
    review = F.coalesce("__p", "__a", F.lit(False))
    return flagged.select(*bridge.columns, review.alias("review_flag"))


def identity_match_rate(all_claims: DataFrame) -> DataFrame:
    """Per tenant: persons known to both systems, to one only, and the rate."""
    found = persons(all_claims)
    in_pam, in_app = F.col("pam_accounts") > 0, F.col("app_accounts") > 0
    return (
        found.groupBy("tenant")
        .agg(
            F.count(F.lit(1)).alias("persons"),
            F.count_if(in_pam & in_app).alias("matched"),
            F.count_if(in_pam & ~in_app).alias("pam_only"),
            F.count_if(in_app & ~in_pam).alias("app_only"),
        )
        .withColumn("match_rate", F.col("matched") / F.col("persons"))
    )


# --- listings ---------------------------------------------------------------------


def accounts_of_one_system(all_claims: DataFrame, system: str) -> DataFrame:
    """Accounts of ``system`` whose person the other system does not know."""
    mine = all_claims.where(F.col("source_system") == system)
    others = all_claims.where(F.col("source_system") != system).select(*PERSON).distinct()
    return mine.join(others, [*PERSON], "left_anti").select(*ACCOUNT, "email_sha256").distinct()


def _customers(facts: DataFrame) -> DataFrame:
    return facts.where("canonical_customer_id IS NOT NULL").select(
        "canonical_customer_id"
    ).distinct()


def customers_seen_only_in(dim: DataFrame, seen: DataFrame, unseen: DataFrame) -> DataFrame:
    """Customers of the dimension with rows in ``seen`` but none in ``unseen``."""
    return (
        dim.join(_customers(seen), "canonical_customer_id", "left_semi")
        .join(_customers(unseen), "canonical_customer_id", "left_anti")
        .select("canonical_customer_id", "tenant", "full_name", "username")
    )


# --- data quality --------------------------------------------------------------------


def rejections_by_reason(labelled: DataFrame) -> DataFrame:
    return (
        labelled.where(F.col(REASON).isNotNull())
        .groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("rejected_count"))
    )


def rejection_rates(labelled_events: DataFrame) -> DataFrame:
    """Per tenant, day and reason: rejected rows and their share of that day.

    The day totals are summed over the already grouped rows, so the window sees
    a handful of rows per tenant and day.
    """
    grouped = labelled_events.groupBy(
        "tenant", F.to_date("event_time_ts").alias("event_date"), REASON
    ).agg(F.count(F.lit(1)).alias("row_count"))
    day = Window.partitionBy("tenant", "event_date")
    return (
        grouped.withColumn("day_rows", F.sum("row_count").over(day))
        .where(F.col(REASON).isNotNull())
        .select(
            "tenant",
            "event_date",
            REASON,
            F.col("row_count").alias("rejected_count"),
            "day_rows",
            (F.col("row_count") / F.col("day_rows")).alias("rejection_rate"),
        )
    )


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, row_count, null_count, min_value, max_value), in one pass."""
    measures = [
        m
        for c in df.columns
        for m in (
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            F.min(c).cast("string").alias(f"{c}__min"),
            F.max(c).cast("string").alias(f"{c}__max"),
        )
    ]
    one = df.agg(F.count(F.lit(1)).alias("row_count"), *measures)
    entries = ", ".join(f"'{c}', {c}__nulls, {c}__min, {c}__max" for c in df.columns)
    return one.selectExpr(
        "row_count",
        f"stack({len(df.columns)}, {entries}) AS (column_name, null_count, min_value, max_value)",
    )


