"""Every operator as a query over the given tables.

A query gets a session and the folder of the tables and returns a DataFrame.
Queries about tables or streams first write what they need below the shared
working folder.  Instants leave without zone, so that any engine compares them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinbridge import streaming, workspace
from kinbridge.contracts import (
    BRIDGE,
    DIM_CUSTOMER,
    FACT_ACTIVITY,
    FACT_SESSION,
    MONEY,
    SOURCE_COLUMNS,
    WAREHOUSE,
)
from kinbridge.functions import canonical_id
from kinbridge.operators import activity_sessions, latest_version
from kinbridge.options import COMPAT, STRICT, Semantics
from kinbridge.plans import drift, facts, identity, incremental, kpis, quality, tenant_rules, validation
from kinbridge.plans.run import QUARANTINE, run
from kinbridge.plans.star import Star, plan_star
from kinbridge.session import configure
from kinbridge.sinks import quarantine, ranges, warehouse
from kinbridge.sources import Sources, from_tables, ndjson, replay, sources_from_tables
from kinbridge.sources.manifest import TenantEntry, TenantRule, fee_limits, read_source
from kinbridge.sources.manifest import tenant_rules as manifest_rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_LOAD = datetime(2024, 2, 1)
SECOND_LOAD = datetime(2024, 2, 2)


def portable(df: DataFrame) -> DataFrame:
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def query(fn: Query) -> Query:
    """Registers a query under its function name."""

    @wraps(fn)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(configure(spark), sf_dir))

    QUERIES[fn.__name__] = prepared
    return fn


def star(spark: SparkSession, sf_dir: str, sem: Semantics = STRICT) -> Star:
    return plan_star(sources_from_tables(spark, sf_dir), sem)


def activity(spark: SparkSession, sf_dir: str, sem: Semantics = STRICT) -> DataFrame:
    return facts.resolved(star(spark, sf_dir, sem).activity, sem)


def sessions(spark: SparkSession, sf_dir: str, sem: Semantics = STRICT) -> DataFrame:
    return facts.resolved(star(spark, sf_dir, sem).session, sem)


# --- sources ---------------------------------------------------------------------


def _ndjson_folder(spark: SparkSession, sf_dir: str) -> str:
    """The four sources as NDJSON, one folder of part files each."""
    folder = workspace.new_folder(spark, "ndjson")
    for name, path in ndjson.source_paths(folder).items():
        getattr(sources_from_tables(spark, sf_dir), name).write.json(path)
    return folder


@query
def source_typed_events(spark, sf_dir):
    return star(spark, sf_dir).events.select(
        "event_id",
        "app_customer_id",
        "tenant",
        "event_type",
        F.col("event_time_ts").alias("event_time"),
        F.col("net_result_decimal").alias("net_result_usdt"),
        F.col("platform_fee_decimal").alias("platform_fee_usdt"),
    )


def _through_ndjson(spark, sf_dir, source: str) -> DataFrame:
    path = f"{workspace.new_folder(spark, 'ndjson')}/{source}.json"
    getattr(sources_from_tables(spark, sf_dir), source).write.json(path)
    return ndjson.read_ndjson(spark, path, source, keep_corrupt=False)


@query
def ndjson_events(spark, sf_dir):
    return _through_ndjson(spark, sf_dir, "activity_events")


@query
def ndjson_sessions(spark, sf_dir):
    return _through_ndjson(spark, sf_dir, "customer_sessions")


@query
def topic_replay_counts(spark, sf_dir):
    found = replay.messages(spark, _ndjson_folder(spark, sf_dir))
    topics = workspace.new_folder(spark, "topics")
    replay.publish_to_folder(found, topics)
    published = spark.read.schema("value string, topic string").text(topics)
    return replay.topic_counts(published)


@query
def tenant_manifest_union(spark, sf_dir):
    """Tenants in files of their own, one of them with its own column names and limit."""
    source = "activity_events"
    raw = sources_from_tables(spark, sf_dir).activity_events
    own_names = {"platform_fee_usdt": "fee", "app_customer_id": "player"}
    folder = workspace.new_folder(spark, "tenants")
    by_tenant = raw.withColumn("owner", F.coalesce("tenant", F.lit("unknown")))
    common = by_tenant.where("owner <> 'tenant-1'")
    common.write.partitionBy("owner").json(f"{folder}/common")
    special = by_tenant.where("owner = 'tenant-1'").drop("owner")
    special.withColumnsRenamed({c: n for c, n in own_names.items()}).write.json(f"{folder}/special")
    entries = [
        TenantEntry("tenant-0", {source: f"{folder}/common/owner=tenant-0"}),
        TenantEntry("tenant-2", {source: f"{folder}/common/owner=tenant-2"}),
        TenantEntry("unknown", {source: f"{folder}/common/owner=unknown"}),
        TenantEntry(
            "tenant-1", {source: f"{folder}/special"}, {source: own_names}, max_platform_fee="10"
        ),
    ]
    labelled = validation.over_fee_limit(
        validation.label_events(read_source(spark, source, entries)), fee_limits(spark, entries)
    )
    verdict = F.coalesce(validation.REASON, F.lit("accepted"))
    return labelled.groupBy("tenant", verdict.alias("verdict")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def tenant_rules_labelled(spark, sf_dir):
    """Tenants with rules of their own, given as rows; one file holds other tenants' rows.

    Files are dealt by customer, so rows without tenant take that of their file.
    """
    source = "activity_events"
    raw = sources_from_tables(spark, sf_dir).activity_events
    folder = workspace.new_folder(spark, "owned")
    number = F.regexp_extract("app_customer_id", r"(\d+)$", 1).try_cast("long")
    owner = F.concat(F.lit("tenant-"), F.coalesce(number % 3, F.lit(0)).cast("string"))
    raw.withColumn("owner", owner).write.partitionBy("owner").json(folder)
    rules = {
        "tenant-0": (
            TenantRule(source, "platform_fee_usdt", "max", "10", "fee_over_limit"),
            TenantRule(source, "event_time", "not_before", "2024-01-03T00:00:00Z"),
        ),
        "tenant-1": (
            TenantRule(source, "event_type", "one_of", "click|purchase|view"),
            TenantRule(source, "net_result_usdt", "min", "-75.5"),
            TenantRule(source, "app_customer_id", "max_length", "6"),
        ),
        "tenant-2": (TenantRule(source, "event_id", "matches", "E-[0-9]*[02468]"),),
    }
    entries = [
        TenantEntry(t, {source: f"{folder}/owner={t}"}, own_files=True, rules=given)
        for t, given in rules.items()
    ]
    labelled = validation.label_events(read_source(spark, source, entries))
    table = tenant_rules.checked(manifest_rules(spark, entries))
    verdict = F.coalesce(validation.REASON, F.lit("accepted"))
    return (
        tenant_rules.apply(labelled, table, source)
        .groupBy("file_tenant", "tenant", verdict.alias("verdict"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


# --- validation --------------------------------------------------------------------


@query
def events_rejected(spark, sf_dir):
    raw = sources_from_tables(spark, sf_dir).activity_events
    return validation.validate_activity_events(raw).rejected


@query
def events_valid(spark, sf_dir):
    return validation.accepted_events(star(spark, sf_dir).events).drop("event_time_ts")


@query
def sessions_rejected(spark, sf_dir):
    raw = sources_from_tables(spark, sf_dir).customer_sessions
    return validation.validate_sessions(raw).rejected


@query
def sessions_valid(spark, sf_dir):
    return validation.accepted(star(spark, sf_dir).sessions).drop("login_at_ts", "logout_at_ts")


@query
def rejections_by_reason(spark, sf_dir):
    st = star(spark, sf_dir)
    parts = [
        quality.rejections_by_reason(df).select(F.lit(name).alias("source"), "*")
        for name, df in (("activity_events", st.events), ("customer_sessions", st.sessions))
    ]
    return parts[0].unionByName(parts[1])


@query
def events_deduplicated(spark, sf_dir):
    raw = sources_from_tables(spark, sf_dir).activity_events
    return validation.validate_activity_events(raw).valid


@query
def sessions_deduplicated(spark, sf_dir):
    raw = sources_from_tables(spark, sf_dir).customer_sessions
    return validation.validate_sessions(raw).valid


# --- identity -----------------------------------------------------------------------


@query
def app_tenant_pairs(spark, sf_dir):
    return identity.observed_tenants(sources_from_tables(spark, sf_dir).activity_events)


@query
def app_enriched(spark, sf_dir):
    return star(spark, sf_dir).app.select(
        "app_customer_id", "username", "email_sha256", "created_at", "tenant"
    )


@query
def canonical_ids(spark, sf_dir):
    people = star(spark, sf_dir).claims.select("tenant", "email_sha256").distinct()
    return people.withColumn("canonical_customer_id", canonical_id("tenant", "email_sha256"))


@query
def unresolvable_accounts(spark, sf_dir):
    st = star(spark, sf_dir)
    return identity.unresolvable_accounts(st.pam, st.app)


@query
def dim_full_join(spark, sf_dir):
    """The full outer match of both systems; the pairs of one person are counted,
    never produced."""
    pairs = F.greatest("pam_accounts", F.lit(1)) * F.greatest("app_accounts", F.lit(1))
    return identity.persons(star(spark, sf_dir).claims).select(
        "tenant", "email_sha256", "pam_accounts", "app_accounts", pairs.alias("joined_rows")
    )


@query
def dim_customer(spark, sf_dir):
    return star(spark, sf_dir).dim_customer


@query
def identity_bridge(spark, sf_dir):
    return star(spark, sf_dir).bridge


@query
def duplicate_emails(spark, sf_dir):
    return quality.duplicate_emails(star(spark, sf_dir).claims)


@query
def missing_emails(spark, sf_dir):
    st = star(spark, sf_dir)
    return quality.missing_emails(st.pam, st.app)


@query
def identity_conflicts(spark, sf_dir):
    return quality.identity_conflicts(star(spark, sf_dir).claims)


@query
def bridge_with_review(spark, sf_dir):
    st = star(spark, sf_dir)
    return quality.bridge_with_review(st.bridge, st.claims)


@query
def identity_match_rate(spark, sf_dir):
    return quality.identity_match_rate(star(spark, sf_dir).claims)


@query
def app_only(spark, sf_dir):
    return quality.accounts_of_one_system(star(spark, sf_dir).claims, identity.APP)


@query
def pam_only(spark, sf_dir):
    return quality.accounts_of_one_system(star(spark, sf_dir).claims, identity.PAM)


# --- facts and KPIs ------------------------------------------------------------------


@query
def fact_activity(spark, sf_dir):
    return activity(spark, sf_dir)


@query
def fact_sessions(spark, sf_dir):
    return sessions(spark, sf_dir)


@query
def unresolved_facts(spark, sf_dir):
    st = star(spark, sf_dir)
    reason = validation.REASON
    events = facts.unresolved(st.activity).select(
        F.lit("activity_events").alias("source"),
        F.col("event_id").alias("source_key"),
        F.col("app_customer_id").alias("account"),
        reason,
    )
    logins = facts.unresolved(st.session).select(
        F.lit("customer_sessions").alias("source"),
        F.col("session_id").alias("source_key"),
        F.col("pam_customer_id").alias("account"),
        reason,
    )
    return events.unionByName(logins)


@query
def kpi_fee_by_tenant(spark, sf_dir):
    return kpis.fee_by_tenant(activity(spark, sf_dir))


@query
def kpi_top_customers(spark, sf_dir):
    return kpis.top_customers(activity(spark, sf_dir))


@query
def kpi_daily_active(spark, sf_dir):
    return kpis.daily_active_customers(activity(spark, sf_dir))


@query
def kpi_daily_active_estimate(spark, sf_dir):
    return kpis.daily_active_customers_estimate(activity(spark, sf_dir))


@query
def kpi_daily_active_within_bound(spark, sf_dir):
    """Stored sketches of two loads, merged by day, against the exact count."""
    rows = _written_once(spark, activity(spark, sf_dir))
    path = workspace.new_folder(spark, "sketches")
    for part in (F.col("event_type") == "click", F.col("event_type") != "click"):
        kpis.active_customer_sketches(rows.where(part)).write.mode("append").parquet(path)
    estimate = kpis.active_customers_from_sketches(spark.read.parquet(path), "event_date")
    exact, off = F.col("daily_active_customers"), F.col("estimated_customers")
    return kpis.daily_active_customers(rows).join(estimate, "event_date").select(
        "event_date",
        exact,
        (F.abs(off - exact) <= F.greatest(F.lit(1.0), exact * kpis.SKETCH_ERROR)).alias("within_bound"),
    )


@query
def pam_session_no_activity(spark, sf_dir):
    st = star(spark, sf_dir)
    return quality.customers_seen_only_in(st.dim_customer, st.session, st.activity)


@query
def active_no_session(spark, sf_dir):
    st = star(spark, sf_dir)
    return quality.customers_seen_only_in(st.dim_customer, st.activity, st.session)


@query
def event_sessions(spark, sf_dir):
    return activity_sessions(from_tables.table(spark, sf_dir, "events"), "user_id", "ts", 30 * 60)


@query
def customer_activity_sessions(spark, sf_dir):
    found = activity_sessions(
        activity(spark, sf_dir),
        "canonical_customer_id",
        "event_time",
        60 * 60,
        sums={"net_result_usdt": F.col("net_result_usdt")},
    )
    return found.withColumn("net_result_usdt", F.col("net_result_usdt").cast(MONEY))


# --- data quality --------------------------------------------------------------------


@query
def rejection_rates(spark, sf_dir):
    return quality.rejection_rates(star(spark, sf_dir).events)


@query
def column_profile(spark, sf_dir):
    events = star(spark, sf_dir).events
    return quality.column_profile(events.select(*SOURCE_COLUMNS["activity_events"]))


@query
def contract_violations(spark, sf_dir):
    """What the compat rules would put into non-null columns."""
    return quality_violations(star(spark, sf_dir, COMPAT).activity)


def quality_violations(facts_df: DataFrame) -> DataFrame:
    return warehouse.contract_violations(facts_df, FACT_ACTIVITY)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tenant, day, measure, value): fees of events and minutes of sessions."""
    fees = activity(spark, sf_dir).select(
        "tenant",
        F.col("event_date").alias("day"),
        F.lit("fee").alias("measure"),
        F.col("platform_fee_usdt").cast("double").alias("value"),
    )
    length = F.unix_micros("logout_at") - F.unix_micros("login_at")
    minutes = sessions(spark, sf_dir).select(
        "tenant",
        F.col("session_date").alias("day"),
        F.lit("minutes").alias("measure"),
        (length / F.lit(60_000_000)).alias("value"),
    )
    return fees.unionByName(minutes)


@query
def value_drift_within_bound(spark, sf_dir):
    """Sketches of two loads against exact ranks, for every tenant, day and quantile.

    ``ranks_fit`` says that each quantile has its rank, ``flag_fits`` that a quantile left
    its band or kept it as exact ranks say; both but for the error of the sketches.
    """
    rows = _written_once(spark, _measured(spark, sf_dir))
    parts = []
    for measure in ("fee", "minutes"):
        mine = rows.where(F.col("measure") == measure)
        path = workspace.new_folder(spark, f"sketches-{measure}")
        for load in (0, 1):
            part = mine.where(F.pmod(F.xxhash64("value"), F.lit(2)) == load)
            drift.value_sketches(part, "day", "value").write.mode("append").parquet(path)
        sketches = spark.read.parquet(path)
        parts.append(_checked_drift(mine, sketches).withColumn("measure", F.lit(measure)))
    return reduce(DataFrame.unionByName, parts)


def _checked_drift(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Counts how many values of the day, and of its past, each quantile really exceeds.

    Rows come in many copies, which their size on disk does not show, bands three a day;
    so it is always the bands that are broadcast.
    """
    days = F.sequence(F.lit(0), F.lit(drift.WINDOW_DAYS))
    dealt = rows.select(
        "tenant", F.explode(days).alias("ago"), F.col("day").alias("at"), F.col("value").alias("v")
    ).select("tenant", F.date_add("at", F.col("ago")).alias("day"), (F.col("ago") > 0).alias("old"), "v")

    def share(old: bool, below: Column) -> Column:
        mine = F.col("old") == F.lit(old)
        return F.count_if(mine & below) / F.count_if(mine)

    upto, below = F.col("v") <= F.col("value"), F.col("v") < F.col("value")
    keys = ("tenant", "day", "q", "value", "low", "high", "n", "past_n")
    counted = (
        dealt.join(F.broadcast(drift.quantile_bands(sketches)), ["tenant", "day"])
        .groupBy(*keys)
        .agg(
            F.count_if(~F.col("old")).alias("day_values"),
            F.count_if("old").alias("past_values"),
            share(False, upto).alias("upto"),
            share(False, below).alias("below"),
            share(True, upto).alias("past_upto"),
            share(True, below).alias("past_below"),
        )
    )
    q, error, moved = F.col("q"), F.lit(drift.RANK_ERROR), F.lit(drift.TOLERANCE)
    ranks = (
        (F.col("below") <= q + error)
        & (F.col("upto") >= q - error)
        & (F.col("n") == F.col("day_values"))
        & (F.col("past_n") == F.col("past_values"))
    )
    not_above = F.col("past_below") <= q + moved + error
    not_under = F.col("past_upto") >= q - moved - error
    flag = (
        F.when(F.col("value") > F.col("high"), F.col("past_below") >= q + moved - error)
        .when(F.col("value") < F.col("low"), F.col("past_upto") <= q - moved + error)
        .otherwise(not_above & not_under)
    )
    return counted.groupBy("tenant", "day", "day_values", "past_values").agg(
        F.bool_and(ranks).alias("ranks_fit"), F.bool_and(flag).alias("flag_fits")
    )


# --- tables ---------------------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str, times: int = 1, only_new: bool = True) -> str:
    """A warehouse loaded from the given tables; returns its root."""
    root = workspace.new_folder(spark, "warehouse")
    for i in range(times):
        stamp = (FIRST_LOAD, SECOND_LOAD)[i % 2]
        run(spark, sources_from_tables(spark, sf_dir), root, loaded_at=stamp, only_new=only_new)
    return root


def _without(df: DataFrame, contract) -> DataFrame:
    return df.drop(contract.version)


def _written_once(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table for results that several loads below read."""
    path = workspace.new_folder(spark, "shared")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query
def warehouse_row_counts(spark, sf_dir):
    return warehouse.row_counts(spark, _loaded(spark, sf_dir))


@query
def rerun_idempotent(spark, sf_dir):
    """Everything appended twice; the current rows are those of one load."""
    root = _loaded(spark, sf_dir, times=2, only_new=False)
    return _without(warehouse.read_current(spark, root, FACT_ACTIVITY), FACT_ACTIVITY)


@query
def rerun_idempotent_dim(spark, sf_dir):
    """Loaded twice, storing only what is new."""
    root = _loaded(spark, sf_dir, times=2)
    return _without(warehouse.read_versions(spark, root, DIM_CUSTOMER), DIM_CUSTOMER)


@query
def kpi_sql_on_views(spark, sf_dir):
    """Free SQL on the loaded tables."""
    warehouse.register_views(spark, _loaded(spark, sf_dir))
    return spark.sql(
        """
        SELECT d.country, f.event_date, count(*) AS event_count,
               count(DISTINCT f.canonical_customer_id) AS customers
        FROM fact_activity_event f
        JOIN dim_customer d USING (tenant, canonical_customer_id)
        GROUP BY d.country, f.event_date
        """
    )


@query
def month_pruned_sessions(spark, sf_dir):
    root = workspace.new_folder(spark, "pruned")
    warehouse.append(sessions(spark, sf_dir), root, FACT_SESSION, FIRST_LOAD)
    spring = warehouse.read_current(spark, root, FACT_SESSION, months=("199703", "199705"))
    return spring.groupBy("session_date").agg(F.count(F.lit(1)).alias("session_count"))


def _two_versions(
    spark: SparkSession, contract, truth: DataFrame, outdated: dict, reloaded
) -> DataFrame:
    """Loads outdated rows, then the part ``reloaded`` as it should be; reads current."""
    root = workspace.new_folder(spark, "versions")
    truth = _written_once(spark, truth)
    warehouse.append(truth.withColumns(outdated), root, contract, FIRST_LOAD)
    warehouse.append(truth.where(reloaded), root, contract, SECOND_LOAD)
    return _without(warehouse.read_current(spark, root, contract), contract)


@query
def latest_version_dim(spark, sf_dir):
    return _two_versions(
        spark,
        DIM_CUSTOMER,
        star(spark, sf_dir).dim_customer,
        {"country": F.lit(None).cast("string")},
        F.col("registered_at").isNotNull(),
    )


@query
def latest_version_bridge(spark, sf_dir):
    return _two_versions(
        spark,
        BRIDGE,
        star(spark, sf_dir).bridge,
        {"email_sha256": F.lit("old")},
        F.col("source_system") == identity.APP,
    )


@query
def latest_version_activity(spark, sf_dir):
    return _two_versions(
        spark,
        FACT_ACTIVITY,
        activity(spark, sf_dir),
        {"platform_fee_usdt": (F.col("platform_fee_usdt") + F.lit(Decimal(1))).cast(MONEY)},
        F.col("event_date") >= "2024-01-16",
    )


@query
def latest_version_session(spark, sf_dir):
    return _two_versions(
        spark,
        FACT_SESSION,
        sessions(spark, sf_dir),
        {"device": F.lit("old")},
        F.col("session_date") >= "1998-01-01",
    )


@query
def compacted_activity(spark, sf_dir):
    root = workspace.new_folder(spark, "compacted")
    rows = _written_once(spark, activity(spark, sf_dir))
    for stamp in (FIRST_LOAD, SECOND_LOAD):
        warehouse.append(rows, root, FACT_ACTIVITY, stamp)
    warehouse.compact(spark, root, FACT_ACTIVITY)
    return _without(warehouse.read_versions(spark, root, FACT_ACTIVITY), FACT_ACTIVITY).drop(
        warehouse.MONTH
    )


@query
def clustered_activity(spark, sf_dir):
    """Half of the events loaded, laid out by tenant and day, read by tenant and days.

    What the whole load brings afterwards lies in files without a description.
    """
    root = _split_load(spark, sf_dir, stamps=(FIRST_LOAD,))
    ranges.cluster(spark, root, FACT_ACTIVITY, files=64)
    run(spark, sources_from_tables(spark, sf_dir), root, loaded_at=SECOND_LOAD)
    wanted = [(f"tenant-{i}", 4 + 3 * i, 12 + 3 * i) for i in range(3)]
    parts = [
        ranges.read(spark, root, FACT_ACTIVITY, date(2024, 1, a), date(2024, 1, b), tenant)
        for tenant, a, b in wanted
    ]
    return _without(reduce(DataFrame.unionByName, parts), FACT_ACTIVITY)


@query
def compacted_session_compat(spark, sf_dir):
    """A PAM id of several tenants keeps its row in each."""
    root = workspace.new_folder(spark, "compacted")
    rows = _written_once(spark, sessions(spark, sf_dir, COMPAT))
    for stamp in (FIRST_LOAD, SECOND_LOAD):
        warehouse.append(rows, root, FACT_SESSION, stamp)
    warehouse.compact(spark, root, FACT_SESSION, COMPAT)
    return _without(warehouse.read_versions(spark, root, FACT_SESSION), FACT_SESSION).drop(
        warehouse.MONTH
    )


@query
def quarantine_table(spark, sf_dir):
    path = workspace.new_folder(spark, "quarantine")
    st = star(spark, sf_dir)
    for source, df in (("activity_events", st.events), ("customer_sessions", st.sessions)):
        quarantine.write(quarantine.as_quarantine(validation.rejected(df), source), path)
    return (
        quarantine.read(spark, path)
        .groupBy("source", validation.REASON)
        .agg(F.count(F.lit(1)).alias("distinct_rows"), F.sum("copies").alias("copies"))
    )


@query
def quarantine_replay(spark, sf_dir):
    """Replayed rows break the same rules again."""
    path = workspace.new_folder(spark, "quarantine")
    source = "activity_events"
    rejected = validation.rejected(star(spark, sf_dir).events)
    quarantine.write(quarantine.as_quarantine(rejected, source), path)
    again = quarantine.replay(quarantine.read(spark, path), source)
    return validation.label_events(again).select(*SOURCE_COLUMNS[source], validation.REASON)


@query
def incremental_new_events(spark, sf_dir):
    """History up to 19 January is loaded; the batch brings everything again."""
    root = workspace.new_folder(spark, "increment")
    batch = _written_once(spark, activity(spark, sf_dir))
    warehouse.append(batch.where("event_date < '2024-01-20'"), root, FACT_ACTIVITY, FIRST_LOAD)
    stored = warehouse.read_versions(spark, root, FACT_ACTIVITY)
    fresh = incremental.not_loaded(batch, stored, FACT_ACTIVITY.natural_key)
    return fresh.select("event_id", "app_customer_id", "event_time")


def _half(column: str = "event_time") -> Column:
    """Half of the raw events; rows that repeat one another with another hour or fee are
    in different halves."""
    hour = F.substring(column, 12, 2).try_cast("int")
    fee = F.floor(F.col("platform_fee_usdt").try_cast("decimal(18,4)")).cast("int")
    return F.coalesce((hour + fee) % 2, F.lit(0)) == 1


def _split_load(spark: SparkSession, sf_dir: str, stamps=(SECOND_LOAD, FIRST_LOAD)) -> str:
    """Two loads of half the events each, the later one under an earlier time."""
    root = workspace.new_folder(spark, "warehouse")
    given = sources_from_tables(spark, sf_dir)
    for part, stamp in zip((_half(), ~_half()), stamps):
        events = given.activity_events.where(part)
        run(spark, _bundle(given)._replace(activity_events=events), root, loaded_at=stamp)
    return root


def _bundle(given) -> Sources:
    return Sources(**{name: getattr(given, name) for name in SOURCE_COLUMNS})


@query
def incremental_split_events(spark, sf_dir):
    """The facts of two loads are those of one, whichever repeat comes first."""
    root = _split_load(spark, sf_dir)
    return _without(warehouse.read_current(spark, root, FACT_ACTIVITY), FACT_ACTIVITY)


@query
def incremental_split_views(spark, sf_dir):
    """The same through the view that reads days by themselves, for some days."""
    warehouse.register_views(spark, _split_load(spark, sf_dir))
    return spark.sql(
        """
        SELECT event_date, tenant, count(*) AS event_count,
               CAST(sum(platform_fee_usdt) AS DECIMAL(38,18)) AS total_platform_fee_usdt
        FROM fact_activity_event
        WHERE event_date BETWEEN DATE'2024-01-05' AND DATE'2024-01-20'
        GROUP BY event_date, tenant
        """
    )


@query
def load_after_email_change(spark, sf_dir):
    """A third of the accounts had another email when the facts were loaded; the next
    load brings the right one, and every table is as if it had been known from the start."""
    root = workspace.new_folder(spark, "warehouse")
    now = _bundle(sources_from_tables(spark, sf_dir))

    def older(customers: DataFrame, account: str) -> DataFrame:
        changed = F.pmod(F.xxhash64(account), F.lit(3)) == 1
        email = F.when(changed, F.sha2(F.concat(F.lit("old-"), account), 256))
        return customers.withColumn("email_sha256", F.coalesce(email, "email_sha256"))

    before = now._replace(
        pam_customers=older(now.pam_customers, "pam_customer_id"),
        app_customers=older(now.app_customers, "app_customer_id"),
    )
    run(spark, before, root, loaded_at=FIRST_LOAD)
    after = now._replace(
        activity_events=now.activity_events.limit(0),
        customer_sessions=now.customer_sessions.limit(0),
    )
    run(spark, after, root, loaded_at=SECOND_LOAD)
    parts = [
        warehouse.read_current(spark, root, contract).select(
            F.lit(contract.name).alias("table_name"),
            F.concat_ws("|", *contract.natural_key).alias("row_key"),
            "canonical_customer_id",
            "tenant",
        )
        for contract in WAREHOUSE.values()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def quarantine_states(spark, sf_dir):
    """Events come in two loads, their customers with the second one."""
    root = workspace.new_folder(spark, "warehouse")
    now = _bundle(sources_from_tables(spark, sf_dir))
    first = now._replace(
        pam_customers=now.pam_customers.limit(0),
        app_customers=now.app_customers.limit(0),
        activity_events=now.activity_events.where(_half()),
    )
    second = now._replace(
        activity_events=now.activity_events.where(~_half()),
        customer_sessions=now.customer_sessions.limit(0),
    )
    run(spark, first, root, loaded_at=FIRST_LOAD)
    run(spark, second, root, loaded_at=SECOND_LOAD)
    states = quarantine.read_states(spark, f"{root}/{QUARANTINE}")
    return states.groupBy("source", validation.REASON, "state").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("copies").alias("copies")
    )


@query
def reidentified_facts(spark, sf_dir):
    """One tenant's customers get new ids; their facts are found again."""
    st = star(spark, sf_dir)
    corrected = F.when(
        F.col("tenant") == "tenant-1", canonical_id(F.lit("late"), "email_sha256")
    ).otherwise(F.col("canonical_customer_id"))
    bridge = st.bridge.withColumn("canonical_customer_id", corrected)
    return incremental.reidentified(facts.resolved(st.activity), bridge).select(
        "event_id", "app_customer_id", "canonical_customer_id"
    )


# --- streams ----------------------------------------------------------------------------


def _table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream.

    A stream reads folders or patterns; the pattern fits a single file as well
    as a folder of part files.
    """
    schema = from_tables.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream, adapted like in batch."""
    return from_tables.activity_events(_table_stream(spark, sf_dir))


def _streamed(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream to its end; returns what it wrote, with the batch number."""
    folder = workspace.new_folder(spark, "stream")
    writer = streaming.write_batches(stream, f"{folder}/out", f"{folder}/checkpoint", mode)
    streaming.run_available(writer)
    return spark.read.parquet(f"{folder}/out")


@query
def stream_validate(spark, sf_dir):
    labelled = streaming.label_stream(_event_stream(spark, sf_dir))
    wanted = ("event_id", "app_customer_id", "tenant", "event_time", validation.REASON)
    return _streamed(spark, labelled.select(*wanted)).select(*wanted)


@query
def stream_dedup(spark, sf_dir):
    """Natural keys only: which of several differing repeats arrives first, and so
    stays, is not defined in a stream."""
    unique = streaming.unique_in_stream(streaming.label_stream(_event_stream(spark, sf_dir)))
    return _streamed(spark, unique.select("event_id", "app_customer_id")).drop("batch_id")


@query
def stream_enrich(spark, sf_dir):
    """The bridge is a written table, as a long-running stream would read it."""
    root = workspace.new_folder(spark, "bridge")
    warehouse.append(star(spark, sf_dir).bridge, root, BRIDGE, FIRST_LOAD)
    bridge = warehouse.read_current(spark, root, BRIDGE)
    unique = streaming.unique_in_stream(streaming.label_stream(_event_stream(spark, sf_dir)))
    wanted = ("event_id", "app_customer_id", "tenant", "canonical_customer_id")
    found = streaming.with_customers(unique, bridge).select(*wanted)
    return _streamed(spark, found).select(*wanted)


@query
def stream_sink(spark, sf_dir):
    """The whole path into the warehouse, then once more from the start: a full
    replay must not change the table."""
    root = workspace.new_folder(spark, "stream-warehouse")
    warehouse.create_tables(spark, root, [WAREHOUSE[FACT_ACTIVITY.name]])
    warehouse.append(star(spark, sf_dir).bridge, root, BRIDGE, FIRST_LOAD)
    for attempt in ("first", "again"):
        labelled = streaming.label_stream(_event_stream(spark, sf_dir))
        writer = streaming.load_warehouse(
            labelled, root, f"{root}/{QUARANTINE}-{attempt}", f"{root}/checkpoint-{attempt}"
        )
        streaming.run_available(writer)
    stored = warehouse.read_versions(spark, root, FACT_ACTIVITY)
    return _without(stored, FACT_ACTIVITY).drop(warehouse.MONTH)


def _two_halves(spark: SparkSession, sf_dir: str, folder: str, **options: str) -> str:
    """A stream into a warehouse in two runs; returns the warehouse's root."""
    root = f"{folder}/warehouse"
    warehouse.create_tables(spark, root, [FACT_ACTIVITY])
    warehouse.append(star(spark, sf_dir).bridge, root, BRIDGE, FIRST_LOAD)
    raw = sources_from_tables(spark, sf_dir).activity_events
    for part in (_half(), ~_half()):
        raw.where(part).write.mode("append").json(f"{folder}/in")
        labelled = streaming.label_stream(streaming.read_events(spark, f"{folder}/in"))
        writer = streaming.load_warehouse(
            labelled, root, f"{root}/{QUARANTINE}", f"{folder}/checkpoint", **options
        )
        streaming.run_available(writer)
    return root


@query
def stream_sink_batches(spark, sf_dir):
    """Several micro-batches; repeats that should win come with later ones."""
    root = _two_halves(spark, sf_dir, workspace.new_folder(spark, "batches"))
    return _without(warehouse.read_current(spark, root, FACT_ACTIVITY), FACT_ACTIVITY)


@query
def stream_trigger(spark, sf_dir):
    """A stream that runs by the clock, is stopped, and goes on from its checkpoint."""
    folder = workspace.new_folder(spark, "trigger")
    root = f"{folder}/warehouse"
    warehouse.create_tables(spark, root, [FACT_ACTIVITY])
    warehouse.append(star(spark, sf_dir).bridge, root, BRIDGE, FIRST_LOAD)
    raw = sources_from_tables(spark, sf_dir).activity_events
    for part in (_half(), ~_half()):
        raw.where(part).write.mode("append").json(f"{folder}/in")
        labelled = streaming.label_stream(streaming.read_events(spark, f"{folder}/in"))
        running = streaming.run_continuously(
            streaming.load_warehouse(
                labelled, root, f"{root}/{QUARANTINE}", f"{folder}/checkpoint"
            ),
            every="1 second",
        )
        running.processAllAvailable()
        running.stop()
    return kpis.fee_by_tenant(warehouse.read_current(spark, root, FACT_ACTIVITY))


def _streamed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity facts that a stream loaded into a warehouse."""
    root = workspace.new_folder(spark, "stream-warehouse")
    warehouse.create_tables(spark, root, [WAREHOUSE[FACT_ACTIVITY.name]])
    warehouse.append(star(spark, sf_dir).bridge, root, BRIDGE, FIRST_LOAD)
    labelled = streaming.label_stream(_event_stream(spark, sf_dir))
    writer = streaming.load_warehouse(
        labelled, root, f"{root}/{QUARANTINE}", f"{root}/checkpoint"
    )
    streaming.run_available(writer)
    return warehouse.read_current(spark, root, FACT_ACTIVITY)


@query
def stream_late_rows(spark, sf_dir):
    """The second half of the month arrives first; what the first half brings
    behind the watermark is dropped and counted."""
    folder = workspace.new_folder(spark, "late")
    raw = sources_from_tables(spark, sf_dir).activity_events
    good = validation.accepted_events(validation.label_events(raw))
    second_half = F.col("event_time_ts") >= "2024-01-16"
    columns = SOURCE_COLUMNS["activity_events"]
    late = streaming.LateRows()
    for part in (second_half, ~second_half):
        good.where(part).select(
            *(F.col(c).cast("string").alias(c) for c in columns)
        ).write.mode("append").json(f"{folder}/in")
        labelled = streaming.label_stream(streaming.read_events(spark, f"{folder}/in"))
        unique = streaming.unique_in_stream(labelled).select("event_id", "app_customer_id")
        streaming.run_available(
            streaming.write_batches(unique, f"{folder}/out", f"{folder}/checkpoint"), late=late
        )
    arrived = spark.read.json(f"{folder}/in", schema="event_id string")
    kept = spark.read.parquet(f"{folder}/out")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return (
        arrived.select(one.alias("arrived"), none.alias("kept"))
        .unionByName(kept.select(none.alias("arrived"), one.alias("kept")))
        .agg(F.sum("arrived").alias("arrived"), F.sum("kept").alias("kept"))
        .withColumn("dropped_late", F.lit(late.total).cast("bigint"))
    )


@query
def stream_late_rows_kept(spark, sf_dir):
    """The second half of the month arrives first.  Late rows are not lost: what arrived is
    what was kept, what repeats it, and what lies in the quarantine as late."""
    folder = workspace.new_folder(spark, "late-kept")
    raw = sources_from_tables(spark, sf_dir).activity_events
    second_half = F.coalesce(F.substring("event_time", 1, 10) >= "2024-01-16", F.lit(True))
    path, held = f"{folder}/in-time", f"{folder}/{QUARANTINE}"
    for part in (second_half, ~second_half):
        raw.where(part).write.mode("append").json(f"{folder}/in")
        labelled = streaming.label_stream(streaming.read_events(spark, f"{folder}/in"))
        writer = streaming.set_late_aside(labelled, path, held, f"{folder}/split")
        streaming.run_available(writer)
    schema = validation.accepted(labelled).schema
    in_time = streaming.read_in_time(spark, path, schema)
    keys = ["event_id", "app_customer_id"]
    unique = in_time.withWatermark("event_time_ts", "1 day").dropDuplicatesWithinWatermark(keys)
    kept = _streamed(spark, unique.select(*keys, "event_time"))
    arrived = spark.read.schema(schema).parquet(f"{path}/rows/*")
    late = quarantine.replay(quarantine.read(spark, held), "activity_events", "late_event")
    copies = quarantine.read(spark, held, "late_event")
    one = F.lit(1).cast("bigint")
    parts = [
        kept.select(F.lit("kept").alias("part"), one.alias("rows")),
        arrived.select(F.lit("in_time").alias("part"), one.alias("rows")),
        late.select(F.lit("late_distinct").alias("part"), one.alias("rows")),
        copies.select(F.lit("late").alias("part"), F.col("copies").alias("rows")),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("part").agg(F.sum("rows").alias("row_count"))


@query
def stream_daily_fee(spark, sf_dir):
    """A running sum over what each batch changes; repeats that win come late."""
    folder = workspace.new_folder(spark, "fees")
    _two_halves(spark, sf_dir, folder, changes_path=f"{folder}/changes")
    sums = streaming.daily_fee_of_changes(streaming.read_changes(spark, f"{folder}/changes"))
    newest = latest_version(_streamed(spark, sums, "update"), ["event_date", "tenant"], "batch_id")
    return newest.where("facts > 0").select("event_date", "tenant", "total_platform_fee_usdt")


@query
def stream_fee_by_tenant(spark, sf_dir):
    return kpis.fee_by_tenant(_streamed_facts(spark, sf_dir))


@query
def stream_daily_active(spark, sf_dir):
    """The stream keeps distinct customer-days; counting them is a batch query."""
    events = validation.accepted_events(streaming.label_stream(_event_stream(spark, sf_dir)))
    enriched = streaming.with_customers(events, star(spark, sf_dir).bridge)
    days = _streamed(spark, streaming.active_customer_days(enriched, delay="1 day"))
    return days.groupBy("event_date").agg(
        F.count_distinct("canonical_customer_id").alias("daily_active_customers")
    )


@query
def stream_sessions(spark, sf_dir):
    """Sessions the watermark has closed by the end of the input."""
    events = _table_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    closed = streaming.session_windows(events, "user_id", "ts", "30 minutes", delay="1 day")
    return _streamed(spark, closed).drop("batch_id")


# --- compat ---------------------------------------------------------------------------------


@query
def compat_events_rejected(spark, sf_dir):
    raw = sources_from_tables(spark, sf_dir).activity_events
    return validation.validate_activity_events(raw, COMPAT).rejected


@query
def compat_events_valid(spark, sf_dir):
    raw = sources_from_tables(spark, sf_dir).activity_events
    return validation.validate_activity_events(raw, COMPAT).valid


@query
def compat_dim_customer(spark, sf_dir):
    return star(spark, sf_dir, COMPAT).dim_customer


@query
def compat_identity_bridge(spark, sf_dir):
    return star(spark, sf_dir, COMPAT).bridge


@query
def compat_fact_activity(spark, sf_dir):
    return activity(spark, sf_dir, COMPAT)


@query
def compat_fact_sessions(spark, sf_dir):
    return sessions(spark, sf_dir, COMPAT)


@query
def compat_kpi_fee_by_tenant(spark, sf_dir):
    return kpis.fee_by_tenant(activity(spark, sf_dir, COMPAT))


@query
def compat_kpi_top_customers(spark, sf_dir):
    return kpis.top_customers(activity(spark, sf_dir, COMPAT))


@query
def compat_kpi_daily_active(spark, sf_dir):
    return kpis.daily_active_customers(activity(spark, sf_dir, COMPAT))
