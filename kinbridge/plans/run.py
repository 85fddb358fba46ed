"""A whole load: raw sources in, warehouse tables and quarantine out."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kinbridge import workspace
from kinbridge.contracts import (
    BRIDGE,
    DIM_CUSTOMER,
    FACT_ACTIVITY,
    FACT_SESSION,
    WAREHOUSE,
    TableContract,
    source_schema,
)
from kinbridge.options import STRICT, Semantics
from kinbridge.plans import facts, identity, tenant_rules, validation
from kinbridge.plans.incremental import not_loaded
from kinbridge.plans.star import labelled_customers
from kinbridge.plans.validation import RANK, REASON
from kinbridge.sinks import keys, merge, quarantine, warehouse
from kinbridge.sources.bundle import Sources

log = logging.getLogger(__name__)

QUARANTINE = "quarantine"
TENANTS = "observed_tenant"
HELD = (facts.UNRESOLVED, facts.AMBIGUOUS)

#: Source of a fact table, and how its facts go back into the source's shape.
_SOURCE_OF = {
    FACT_ACTIVITY.name: ("activity_events", quarantine.held_events),
    FACT_SESSION.name: ("customer_sessions", quarantine.held_sessions),
}

Result = TypeVar("Result")


@dataclass
class RunReport:
    """Rows read and rejected per source, counted while they were written."""

    rows: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class _Load:
    spark: SparkSession
    root: str
    stage: str
    sem: Semantics
    loaded_at: datetime | None
    only_new: bool
    retry_held: bool
    whole_history: bool
    one_at_a_time: Lock = field(default_factory=Lock)

    @property
    def load_id(self) -> str | None:
        """A load with a given time is the same load when it is repeated."""
        return None if self.loaded_at is None else self.loaded_at.isoformat()

    @property
    def quarantine(self) -> str:
        return f"{self.root}/{QUARANTINE}"

    @property
    def tenants(self) -> str:
        return f"{self.root}/{TENANTS}"


def run(
    spark: SparkSession,
    sources: Sources,
    root: str,
    sem: Semantics = STRICT,
    *,
    loaded_at: datetime | None = None,
    fee_limits: DataFrame | None = None,
    rules: DataFrame | None = None,
    only_new: bool = True,
    retry_held: bool = True,
    whole_history: bool = True,
) -> RunReport:
    """Loads one set of sources into the warehouse below ``root``.

    Customer sources are snapshots; event and session sources may be a part of
    the history.  With ``only_new`` rows already stored are not stored again;
    without it everything is appended as a newer version.  Either way a repeated
    run leaves the current tables unchanged.  ``retry_held`` gives rows held for
    an unknown customer another chance.  A stored repeat is found in whatever
    month it lies; ``whole_history=False`` looks in the months of the batch only,
    for sources that never send a repeat with another time.  ``rules`` (see
    ``plans.tenant_rules``) are further rules for the events of single tenants.

    Steps that do not depend on each other run side by side, each writing to a
    folder of its own.
    """
    load = _Load(
        spark,
        root.rstrip("/"),
        workspace.new_folder(spark, "stage"),
        sem,
        loaded_at,
        only_new,
        retry_held,
        whole_history,
    )
    report = RunReport()
    _make_tables(load)

    labelled = validation.label_events(sources.activity_events, sem)
    if fee_limits is not None:
        labelled = validation.over_fee_limit(labelled, fee_limits)
    if rules is not None:
        labelled = tenant_rules.apply(labelled, tenant_rules.checked(rules), "activity_events")
    customers = _store_customers if sem.replace_by_natural_key else _identities

    def of_events():
        staged = _stage_labelled(load, labelled, "activity_events", report)
        _, known = _together(
            spark,
            lambda: _reject(load, staged, "activity_events"),
            lambda: customers(load, sources, staged),
        )
        return staged, known

    def of_sessions() -> DataFrame:
        rows = validation.label_sessions(sources.customer_sessions, sem)
        staged = _stage_labelled(load, rows, "customer_sessions", report)
        _reject(load, staged, "customer_sessions")
        return staged

    # Customers need the tenants of events only; their many small steps fill the gaps.
    (events, known), sessions = _together(spark, of_events, of_sessions)
    if not sem.replace_by_natural_key:
        dim, links, _ = known
        _load_historic(load, dim, links, events, sessions)
        workspace.remove(spark, load.stage)
        return report
    bridge = known

    good_events = validation.accepted_events(_verdict(events, False))
    good_sessions = validation.accepted(_verdict(sessions, False))
    if retry_held:
        held = _stage(quarantine.read(spark, load.quarantine, *HELD), f"{load.stage}/held")
        again = validation.label_events(quarantine.replay(held, "activity_events", *HELD), sem)
        again = _stage(validation.accepted_events(again), f"{load.stage}/held_events")
        good_events = good_events.unionByName(again)
        again = validation.label_sessions(quarantine.replay(held, "customer_sessions", *HELD), sem)
        again = _stage(validation.accepted(again), f"{load.stage}/held_sessions")
        good_sessions = good_sessions.unionByName(again)

    def activity(rows: DataFrame, *carried: str) -> DataFrame:
        return facts.ranked_activity(rows, bridge, *carried)

    def logins(rows: DataFrame, *carried: str) -> DataFrame:
        return facts.ranked_sessions(rows, bridge, sem, *carried)

    events, sessions = validation.unique_events, validation.unique_sessions
    _together(
        spark,
        lambda: _merge(load, good_events, events, validation.event_rank(), activity, FACT_ACTIVITY),
        lambda: _merge(load, good_sessions, sessions, validation.session_rank(), logins, FACT_SESSION),
    )
    if retry_held:
        _retire_held(load, held)
    workspace.remove(spark, load.stage)
    return report


def _reject(load: _Load, staged: DataFrame, source: str) -> None:
    """Adds a source's rejected rows to the quarantine."""
    bad = quarantine.as_quarantine(_verdict(staged, True), source, load.loaded_at, load.load_id)
    _quarantine(load, bad)


def _quarantine(load: _Load, bad: DataFrame) -> None:
    # Two jobs that append to one folder would remove each other's unfinished files.
    with load.one_at_a_time:
        quarantine.append_new(bad, load.quarantine)


def _identities(
    load: _Load, sources: Sources, events: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dimension and bridge of this load, and the accounts it brings."""
    pam, app = labelled_customers(sources, _tenants(load, events), load.sem)
    claims = _stage(identity.claims(pam, app), f"{load.stage}/claims")
    dim = identity.customer_dimension(claims, load.sem)
    return dim, identity.identity_bridge(claims), identity.accounts(pam, app)


def _store_customers(load: _Load, sources: Sources, events: DataFrame) -> DataFrame:
    """Stores dimension and bridge; returns the current bridge."""
    dim, links, accounts = _identities(load, sources, events)
    if workspace.children(load.spark, warehouse.table_path(load.root, BRIDGE)):
        return _update_customers(load, dim, links, accounts)
    _together(
        load.spark,
        lambda: warehouse.append(dim, load.root, DIM_CUSTOMER, load.loaded_at),
        lambda: warehouse.append(links, load.root, BRIDGE, load.loaded_at),
    )
    # One version of each link; nothing is to be chosen.
    return warehouse.read_versions(load.spark, load.root, BRIDGE)


def _load_historic(
    load: _Load, dim: DataFrame, links: DataFrame, events: DataFrame, sessions: DataFrame
) -> None:
    """The load under the historic replace keys: what is stored is never improved."""
    for rows, contract in ((dim, DIM_CUSTOMER), (links, BRIDGE)):
        if load.only_new:
            stored = warehouse.read_current(load.spark, load.root, contract, by_natural_key=False)
            rows = rows.subtract(stored.select(*rows.columns))
        warehouse.append(rows, load.root, contract, load.loaded_at)
    bridge = warehouse.read_current(load.spark, load.root, BRIDGE, by_natural_key=False)
    good_events = validation.accepted_events(_verdict(events, False))
    good_sessions = validation.accepted(_verdict(sessions, False))
    stored_events = _stored(load, good_events, "event_time_ts", FACT_ACTIVITY)
    stored_logins = _stored(load, good_sessions, "login_at_ts", FACT_SESSION)
    fresh_events = _fresh(validation.unique_events(good_events), stored_events, FACT_ACTIVITY)
    fresh_logins = _fresh(validation.unique_sessions(good_sessions), stored_logins, FACT_SESSION)
    for rows, contract in (
        (facts.activity_facts(fresh_events, bridge), FACT_ACTIVITY),
        (facts.session_facts(fresh_logins, bridge, load.sem), FACT_SESSION),
    ):
        warehouse.append(facts.resolved(rows, load.sem), load.root, contract, load.loaded_at)


def _together(spark: SparkSession, *steps: Callable[[], Result]) -> list[Result]:
    """Runs independent writes side by side, so that one's tail leaves no executor idle."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        waiting = [pool.submit(inherit(step)) for step in steps]
        return [w.result() for w in waiting]


def _make_tables(load: _Load) -> None:
    _together(
        load.spark,
        lambda: quarantine.make_table(load.spark, load.quarantine),
        *(
            lambda table=table: warehouse.create_tables(load.spark, load.root, [table])
            for table in WAREHOUSE.values()
        ),
    )
    if load.sem.replace_by_natural_key:
        _together(
            load.spark,
            *(
                lambda table=table: keys.make(load.spark, load.root, table)
                for table in (FACT_ACTIVITY, FACT_SESSION)
            ),
        )


def _stage(df: DataFrame, path: str, *split_by: str) -> DataFrame:
    """Writes an intermediate table that several later plans read.

    A written table is computed once, is columnar, cuts the lineage and does
    not depend on the executors that computed it.  ``split_by`` keeps the rows
    of later readers in files of their own.
    """
    df.write.option("compression", warehouse.CODEC).partitionBy(*split_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stage_labelled(load: _Load, df: DataFrame, source: str, report: RunReport) -> DataFrame:
    seen = Observation(f"{source}-{load.stage[-12:]}")
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    ).withColumn("is_rejected", F.col(REASON).isNotNull())
    staged = _stage(counted, f"{load.stage}/{source}", "is_rejected")
    report.rows[source] = seen.get["rows"]
    report.rejected[source] = seen.get["rejected"]
    if report.rejected[source]:
        log.warning("%s: %d rows rejected", source, report.rejected[source])
    return staged


def _verdict(staged: DataFrame, is_rejected: bool) -> DataFrame:
    return staged.where(F.col("is_rejected") == F.lit(is_rejected)).drop("is_rejected")


def _tenants(load: _Load, events: DataFrame) -> DataFrame:
    """Tenants of app accounts, from this load and all earlier ones."""
    if load.sem.tenants_from_accepted_only:
        events = validation.accepted(_verdict(events, False))
    else:
        # A tenant that a file must not hold is no tenant of the file's accounts.
        events = events.where(~F.col(REASON).eqNullSafe(validation.WRONG_TENANT.reason))
    pairs = identity.observed_tenants(events, load.sem)
    if warehouse.exists(load.spark, load.tenants):
        pairs = pairs.subtract(load.spark.read.schema(pairs.schema).parquet(load.tenants))
    pairs.write.mode("append").parquet(load.tenants)
    return load.spark.read.schema(pairs.schema).parquet(load.tenants).distinct()


def _update_customers(
    load: _Load, dim: DataFrame, links: DataFrame, accounts: DataFrame
) -> DataFrame:
    """Brings dimension, bridge and stored facts to the identities this load knows; returns
    the current bridge."""
    spark, stage = load.spark, load.stage
    links = _stage(links, f"{stage}/bridge")
    accounts = _stage(accounts, f"{stage}/accounts")
    before = _stage(warehouse.newest(spark, load.root, BRIDGE), f"{stage}/bridge_before")
    gone = identity.lost_links(_present(before), links, accounts)
    _load_changes(load, links, before, gone, BRIDGE)
    bridge = _stage(warehouse.read_current(spark, load.root, BRIDGE), f"{stage}/bridge_now")
    customers = _stage(warehouse.newest(spark, load.root, DIM_CUSTOMER), f"{stage}/dim_before")
    person = ["tenant", "canonical_customer_id"]
    alone = _present(customers).join(dim, person, "left_anti").join(bridge, person, "left_anti")
    _together(
        spark,
        lambda: _load_changes(load, dim, customers, alone, DIM_CUSTOMER),
        lambda: _follow_identities(load, _present(before), links, accounts, bridge),
    )
    return bridge


def _present(newest: DataFrame) -> DataFrame:
    return newest.where(~F.coalesce(warehouse.WITHDRAWN, F.lit(False)))


def _load_changes(
    load: _Load, rows: DataFrame, before: DataFrame, gone: DataFrame, contract: TableContract
) -> None:
    """Appends new and changed rows, and withdrawn versions of those that are gone."""
    if load.only_new:
        rows = warehouse.changed_rows(rows, before, contract, load.loaded_at)
    else:
        rows = rows.withColumn(contract.version, merge.stamp(load.loaded_at))
    later = merge.later(load.loaded_at, F.col(contract.version))
    withdrawn = gone.select(*rows.columns).withColumn(contract.version, later)
    warehouse.append(
        rows.withColumn(warehouse.WITHDRAWN, F.lit(False)).unionByName(
            withdrawn.withColumn(warehouse.WITHDRAWN, F.lit(True))
        ),
        load.root,
        contract,
    )


def _follow_identities(
    load: _Load, before: DataFrame, links: DataFrame, accounts: DataFrame, bridge: DataFrame
) -> None:
    """Gives stored facts of accounts whose links changed the customer they have now.

    Facts that lose their customer are withdrawn and held back like new ones.
    """
    changed = _stage(identity.relinked_accounts(before, links, accounts), f"{load.stage}/relinked")
    if changed.isEmpty():
        return
    for contract, system, account in (
        (FACT_ACTIVITY, identity.APP, "app_customer_id"),
        (FACT_SESSION, identity.PAM, "pam_customer_id"),
    ):
        mine = changed.where(F.col("source_system") == system).select(
            F.col("source_customer_id").alias(account)
        )
        stored = warehouse.read_current(load.spark, load.root, contract).drop(contract.version)
        who = F.struct("tenant", "canonical_customer_id")
        moved = facts.relinked(
            stored.join(mine, account, "left_semi").withColumn("was", who), contract, bridge, load.sem
        ).where(~who.eqNullSafe(F.col("was")))
        moved = _stage(moved.drop("was"), f"{load.stage}/moved_{contract.name}")
        taken = merge.corrected(load.spark, load.root, contract, moved, load.loaded_at)
        path = f"{load.stage}/corrected_{contract.name}"
        _store(load, _stage(taken, path), contract, path)


def _merge(
    load: _Load,
    good: DataFrame,
    unique: Callable[[DataFrame], DataFrame],
    rank: Column,
    with_customers: Callable[..., DataFrame],
    contract: TableContract,
) -> None:
    """Stores what the table lacks of accepted rows, a written table; they are written once
    more, when it is known which are taken."""
    spark, root, path = load.spark, load.root, f"{load.stage}/taken_{contract.name}"
    if keys.is_empty(spark, root, contract):
        batch = _stage(with_customers(unique(good)), path)
        taken = merge.improving(spark, root, contract, batch, load.loaded_at)
    else:
        key = good.select(*contract.natural_key)
        rows = merge.open_to_change(
            spark, root, contract, unique(good), rank, key, again=not load.only_new
        )
        found = with_customers(rows, keys.KNOWN, merge.MUST_RESOLVE)
        taken = _stage(merge.with_customers_found(found, contract, load.loaded_at), path)
    _store(load, taken, contract, path)


def _store(load: _Load, taken: DataFrame, contract: TableContract, path: str) -> None:
    """Holds back facts without a customer, then commits the table; ``path`` holds them."""
    source, as_source = _SOURCE_OF[contract.name]
    if load.sem.facts_need_identity:
        held = as_source(facts.unresolved(taken))
        bad = quarantine.as_quarantine(held, source, load.loaded_at, load.load_id)
        _quarantine(load, bad)
    merge.commit(load.spark, load.root, contract, taken, path)


def _retire_held(load: _Load, held: DataFrame) -> None:
    """Marks held rows as resolved whose key is stored by now, or held with a better row."""
    if held.isEmpty():
        return
    for contract, label, rank in (
        (FACT_ACTIVITY, _typed_events, validation.event_rank()),
        (FACT_SESSION, validation.label_sessions, validation.session_rank()),
    ):
        source, _ = _SOURCE_OF[contract.name]
        key = list(contract.natural_key)
        given = F.from_json("payload", source_schema(source))
        kept = F.struct(*quarantine.IDENTITY).alias("kept")
        mine = held.where(F.col("source") == source).select(kept, given.alias("given"))
        ranked = label(mine.select("kept", "given.*")).select("kept", *key, rank.alias(RANK))
        known = keys.known(load.spark, load.root, contract, ranked.select(*key), brief=True)
        better = F.col(f"{keys.KNOWN}.stored") | (F.col(f"{keys.KNOWN}.rank") < F.col(RANK))
        done = ranked.join(known, key).where(better).select("kept.*")
        quarantine.change_state(
            done, load.quarantine, quarantine.RESOLVED, load.loaded_at, load.load_id
        )


def _typed_events(raw: DataFrame) -> DataFrame:
    return validation.label_events(raw).withColumns(
        {
            "net_result_usdt": F.col("net_result_decimal"),
            "platform_fee_usdt": F.col("platform_fee_decimal"),
        }
    )


def _stored(
    load: _Load, batch: DataFrame, instant: str, contract: TableContract
) -> DataFrame | None:
    """Stored rows that could repeat rows of the batch, None when there are none.

    A repeat may carry another time, so it is looked for in all months, by key
    columns only; without ``whole_history`` in the months of the batch.
    """
    if not load.only_new:
        return None
    months = None if load.whole_history else warehouse.months_in(batch, instant)
    stored = warehouse.read_versions(load.spark, load.root, contract, months)
    return None if stored.isEmpty() else stored


def _fresh(rows: DataFrame, stored: DataFrame | None, contract: TableContract) -> DataFrame:
    return rows if stored is None else not_loaded(rows, stored, contract.natural_key)
