"""Who is who: accounts of two systems resolved to one customer per tenant.

Both systems' accounts are brought to one shape (``claims``).  The bridge and
the dimension are then plain aggregations of the claims: matching accounts on a
key they share is grouping by it.  Compared with joining the systems this needs
one shuffle, combines before it, and never pairs the accounts of a hot email.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinbridge.contracts import CORRUPT_COLUMN
from kinbridge.functions import blank_to_null, canonical_id
from kinbridge.functions.identity import SEPARATOR
from kinbridge.options import STRICT, Semantics
from kinbridge.plans.validation import (
    REASON,
    accepted,
    accepted_events,
    label_events,
    rejected,
)

# Names of the two source systems.
PAM = "PAM"
APP = "APP"

PERSON = ("tenant", "email_sha256")


# --- tenants of app accounts -------------------------------------------------


def observed_tenants(raw_events: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """Distinct (app_customer_id, tenant) pairs seen in the events."""
    if sem.tenants_from_accepted_only:
        pairs = accepted_events(label_events(raw_events, sem))
    else:
        pairs = raw_events
    pairs = pairs.select("app_customer_id", "tenant")
    if sem.blank_is_missing:
        pairs = pairs.select(*(blank_to_null(c).alias(c) for c in pairs.columns))
    if sem.known_tenants_only:
        pairs = pairs.where("app_customer_id IS NOT NULL AND tenant IS NOT NULL")
        if sem.forbid_separator_in_tenant:
            pairs = pairs.where(~F.contains("tenant", F.lit(SEPARATOR)))
    return pairs.distinct()


def with_tenants(
    app: DataFrame, tenants: DataFrame, pam_accepted: DataFrame, sem: Semantics = STRICT
) -> DataFrame:
    """App accounts, one row per tenant they were seen in.

    An account without events takes the tenant of the PAM accounts with its
    email, provided they all agree.
    """
    app = app.drop(CORRUPT_COLUMN)
    if sem.blank_is_missing:
        app = app.select(*(blank_to_null(c).alias(c) for c in app.columns))
    enriched = app.distinct().join(tenants, "app_customer_id", "left")
    if not sem.tenant_from_pam_twin:
        return enriched
    twins = (
        pam_accepted.groupBy("email_sha256")
        .agg(F.min("tenant").alias("twin_tenant"), F.max("tenant").alias("__other"))
        .where(F.col("twin_tenant") == F.col("__other"))
        .drop("__other")
    )
    return (
        enriched.join(twins, "email_sha256", "left")
        .withColumn("tenant", F.coalesce("tenant", "twin_tenant"))
        .select("app_customer_id", "username", "email_sha256", "created_at", "tenant")
    )


# --- claims --------------------------------------------------------------------


def claims(pam_labelled: DataFrame, app_labelled: DataFrame) -> DataFrame:
    """Accepted accounts of both systems in one shape."""
    missing = F.lit(None).cast("string")
    pam = accepted(pam_labelled).select(
        F.lit(PAM).alias("source_system"),
        F.col("pam_customer_id").alias("source_customer_id"),
        "tenant",
        "email_sha256",
        "full_name",
        missing.alias("username"),
        "country",
        F.col("registered_at").alias("since"),
        F.col("registered_at_ts").alias("since_ts"),
    )
    app = accepted(app_labelled).select(
        F.lit(APP).alias("source_system"),
        F.col("app_customer_id").alias("source_customer_id"),
        "tenant",
        "email_sha256",
        missing.alias("full_name"),
        "username",
        missing.alias("country"),
        F.col("created_at").alias("since"),
        F.col("created_at_ts").alias("since_ts"),
    )
    return pam.unionByName(app)


def unresolvable_accounts(pam_labelled: DataFrame, app_labelled: DataFrame) -> DataFrame:
    """Accounts without a safe identity, for review instead of a guess."""
    shape = ("source_system", "source_customer_id", "tenant", "email_sha256", REASON)
    pam = rejected(pam_labelled).select(
        F.lit(PAM).alias(shape[0]), F.col("pam_customer_id").alias(shape[1]), *shape[2:]
    )
    app = rejected(app_labelled).select(
        F.lit(APP).alias(shape[0]), F.col("app_customer_id").alias(shape[1]), *shape[2:]
    )
    return pam.unionByName(app)


# --- bridge ----------------------------------------------------------------------


def identity_bridge(all_claims: DataFrame) -> DataFrame:
    """One row per (tenant, source system, source id); the smallest email wins."""
    return (
        all_claims.groupBy("tenant", "source_system", "source_customer_id")
        .agg(F.min("email_sha256").alias("email_sha256"))
        .select(
            canonical_id("tenant", "email_sha256").alias("canonical_customer_id"),
            "tenant",
            "source_system",
            "source_customer_id",
            "email_sha256",
        )
    )


def accounts(pam_labelled: DataFrame, app_labelled: DataFrame) -> DataFrame:
    """(source_system, source_customer_id) of all accounts of a load, rejected ones too."""
    pam = pam_labelled.select(F.lit(PAM).alias("source_system"), F.col("pam_customer_id").alias("id"))
    app = app_labelled.select(F.lit(APP).alias("source_system"), F.col("app_customer_id").alias("id"))
    found = pam.unionByName(app).where("id IS NOT NULL").distinct()
    return found.withColumnRenamed("id", "source_customer_id")


def lost_links(before: DataFrame, now: DataFrame, brought: DataFrame) -> DataFrame:
    """Links of an earlier load that the accounts ``brought`` by this one no longer have.

    Accounts that this load does not bring keep their links.
    """
    gone = before.join(now, ["tenant", "source_system", "source_customer_id"], "left_anti")
    return gone.join(brought, ["source_system", "source_customer_id"], "left_semi")


def relinked_accounts(before: DataFrame, now: DataFrame, brought: DataFrame) -> DataFrame:
    """(source_system, source_customer_id) of known accounts with other links than before."""
    account = ["source_system", "source_customer_id"]
    link = [*account, "tenant", "canonical_customer_id"]
    old = before.select(*link, F.lit(1).alias("side"))
    new = now.select(*link, F.lit(2).alias("side"))
    sides = old.unionByName(new).groupBy(*link).agg(F.bit_or("side").alias("sides"))
    changed = sides.where("sides <> 3").select(*account).distinct()
    return changed.join(old, account, "left_semi").join(brought, account, "left_semi")


# --- dimension -----------------------------------------------------------------


def _earliest_account(system: str, *payload: str) -> Column:
    """Aggregate: the account of one system with the earliest time, as a struct.

    Structs compare field by field, so the leading flag puts unknown times last
    and the id makes the choice total.  Accounts of the other system are NULL
    and ignored.
    """
    account = F.struct(
        F.col("since_ts").isNull().alias("unknown"),
        "since_ts",
        F.col("since").isNotNull().alias("given"),
        "source_customer_id",
        "since",
        *payload,
    )
    return F.min(F.when(F.col("source_system") == system, account))


def persons(all_claims: DataFrame) -> DataFrame:
    """Per (tenant, email): earliest account and number of accounts per system.

    This is the full outer match of both systems, one row per person.
    """
    return all_claims.groupBy(*PERSON).agg(
        _earliest_account(PAM, "full_name", "country").alias("pam"),
        _earliest_account(APP, "username").alias("app"),
        F.count_if(F.col("source_system") == PAM).alias("pam_accounts"),
        F.count_if(F.col("source_system") == APP).alias("app_accounts"),
    )


def _profile(matched: DataFrame, sem: Semantics) -> DataFrame:
    registered, created = F.col("pam.since_ts"), F.col("app.since_ts")
    if sem.earliest_first_seen:
        first_seen = F.least(registered, created)
    elif sem.iso_timestamps_only:
        first_seen = F.coalesce(registered, created)
    else:
        # Historic: any given PAM text wins, even one that does not parse.
        first_seen = F.when(F.col("pam.given"), registered).otherwise(created)
    return matched.select(
        "tenant",
        "email_sha256",
        F.col("pam.full_name").alias("full_name"),
        F.col("app.username").alias("username"),
        F.col("pam.country").alias("country"),
        registered.alias("registered_at"),
        first_seen.alias("first_seen_at"),
        canonical_id("tenant", "email_sha256").alias("canonical_customer_id"),
        F.col("pam.source_customer_id").alias("__pam_id"),
        created.alias("__created"),
        F.col("app.source_customer_id").alias("__app_id"),
    )


def customer_dimension(all_claims: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """One row per canonical customer."""
    if sem.tenant_scoped_match:
        return _profile(persons(all_claims), sem).drop("__pam_id", "__created", "__app_id")
    return _dimension_by_email(all_claims, sem)


def _dimension_by_email(all_claims: DataFrame, sem: Semantics) -> DataFrame:
    """Historic match on email alone, without pairing accounts.

    Only a person's own earliest PAM account and the email's earliest app
    account can win, so both are reduced before they meet.  The window then sees
    one row per tenant an email occurs in.
    """
    found = persons(all_claims)
    same_email = Window.partitionBy("email_sha256")
    known = F.col("email_sha256").isNotNull()
    located = found.withColumns(
        {
            "first_app": F.when(known, F.min("app").over(same_email)),
            "in_pam": known & F.bool_or(F.col("pam").isNotNull()).over(same_email),
        }
    )
    nobody = F.lit(None).cast(found.schema["pam"].dataType)
    from_pam = F.when(
        F.col("pam").isNotNull() & F.col("tenant").isNotNull(),
        F.struct("pam", F.col("first_app").alias("app")),
    )
    from_app = F.when(
        F.col("app").isNotNull() & ~F.col("in_pam"), F.struct(nobody.alias("pam"), "app")
    )
    own_tenant = located.select(
        *PERSON, F.explode(F.array_compact(F.array(from_pam, from_app))).alias("m")
    ).select(*PERSON, "m.pam", "m.app")
    # A PAM account without tenant takes the tenant of each app account it meets.
    homeless = found.where("tenant IS NULL AND pam IS NOT NULL").select("email_sha256", "pam")
    hosts = found.where("app IS NOT NULL").select(*PERSON, "app")
    borrowed = homeless.join(hosts, "email_sha256", "left")
    return _one_profile_per_id(_profile(own_tenant.unionByName(borrowed), sem))


def _one_profile_per_id(profiles: DataFrame) -> DataFrame:
    payload = [c for c in profiles.columns if c != "canonical_customer_id"]
    order = [
        F.col("registered_at").isNull().alias("o1"),
        F.col("registered_at").alias("o2"),
        F.col("first_seen_at").isNull().alias("o3"),
        F.col("first_seen_at").alias("o4"),
        F.col("email_sha256").alias("o5"),
        F.col("__pam_id").alias("o6"),
        F.col("__created").isNull().alias("o7"),
        F.col("__created").alias("o8"),
        F.col("__app_id").alias("o9"),
    ]
    best = profiles.groupBy("canonical_customer_id").agg(
        F.min(F.struct(*order, F.struct(*payload).alias("row"))).alias("best")
    )
    wanted = [c for c in payload if not c.startswith("__")]
    return best.select(
        *(F.col(f"best.row.{c}").alias(c) for c in wanted), "canonical_customer_id"
    )
