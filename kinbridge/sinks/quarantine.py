"""Rejected rows, kept with their reason and replayable.

The table holds changes only: a load adds its rejected rows as held, and marks as
resolved what it no longer has to hold.  Nothing is read to add rows.  A row's state is
that of its latest change, its copies are those of all loads.  A load is known by its
name: changes that a repeated load writes again count once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge import workspace
from kinbridge.contracts import CORRUPT_COLUMN, SOURCE_COLUMNS, source_schema
from kinbridge.plans.validation import RANK, REASON

IDENTITY = ("source", REASON, "payload", "raw_line")
COLUMNS = (*IDENTITY, "copies", "rejected_at")
#: States of a row: waiting, no longer needed, given up.
HELD, RESOLVED, EXPIRED = "held", "resolved", "expired"
MONTH = "ym"
SCHEMA = (
    "payload string, raw_line string, copies bigint, rejected_at timestamp, "
    "load_id string, state string, source string, rejection_reason string, ym string"
)
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def as_quarantine(
    rejected: DataFrame,
    source: str,
    rejected_at: datetime | None = None,
    load_id: str | None = None,
) -> DataFrame:
    """Any source's rejected rows in one shape; the raw columns travel as JSON.

    Equal rows become one with their number of copies, before the shuffle.  A load
    without a name is named by its time.
    """
    stamp = F.current_timestamp() if rejected_at is None else F.lit(rejected_at)
    raw_line = F.col(CORRUPT_COLUMN) if CORRUPT_COLUMN in rejected.columns else F.lit(None)
    contract = [F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS[source]]
    return (
        rejected.select(
            F.lit(source).alias("source"),
            REASON,
            F.to_json(F.struct(*contract)).alias("payload"),
            raw_line.cast("string").alias("raw_line"),
        )
        .groupBy(*IDENTITY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("rejected_at", stamp)
        .withColumns(_named(load_id, HELD))
    )


def _named(load_id: str | None, state: str) -> dict[str, Column]:
    name = F.col("rejected_at").cast("string") if load_id is None else F.lit(load_id)
    return {"load_id": name, "state": F.lit(state)}


def held_events(unresolved_facts: DataFrame) -> DataFrame:
    """Unresolved activity facts in the shape of their source, as they were given."""
    iso = F.date_format("event_time", ISO_MILLIS)
    return unresolved_facts.withColumn("event_time", _as_given(unresolved_facts, "event_time", iso))


def held_sessions(unresolved_facts: DataFrame) -> DataFrame:
    return unresolved_facts.withColumns(
        {
            c: _as_given(unresolved_facts, c, F.date_format(c, ISO_MILLIS))
            for c in ("login_at", "logout_at")
        }
    )


def _as_given(facts: DataFrame, column: str, otherwise: Column) -> Column:
    """The text a rank still has, so that a replayed row ranks as before."""
    return F.coalesce(F.col(f"{RANK}.{column}"), otherwise) if RANK in facts.columns else otherwise


def write(quarantined: DataFrame, path: str, mode: str = "append") -> None:
    """Partitioned by source, reason and month; a reason with most rows is split."""
    partitions = ("source", REASON, MONTH)
    (
        quarantined.withColumn(MONTH, F.date_format("rejected_at", "yyyyMM"))
        .hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions)
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )


def make_table(spark: SparkSession, path: str) -> None:
    """Makes the table readable; an existing one stays as it is."""
    workspace.make_folder(spark, path)


def changes(spark: SparkSession, path: str) -> DataFrame:
    """Every change, each load's once."""
    # Dealt by what every later grouping has in common, so that the payloads move once.
    stored = spark.read.schema(SCHEMA).parquet(path).repartition(*IDENTITY)
    return stored.groupBy(*IDENTITY, "load_id", "state").agg(
        F.max("copies").alias("copies"), F.max("rejected_at").alias("rejected_at")
    )


def read_states(spark: SparkSession, path: str, *reasons: str) -> DataFrame:
    """Each row with its state, all its copies, and the times it came first and changed last."""
    found = changes(spark, path)
    if reasons:
        found = found.where(F.col(REASON).isin(*reasons))
    # Of one load's changes the resolving one is the later.
    latest = F.max(F.struct("rejected_at", F.col("state") != HELD, "state"))
    return (
        found.groupBy(*IDENTITY)
        .agg(
            F.sum("copies").alias("copies"),
            F.min("rejected_at").alias("rejected_at"),
            latest.alias("latest"),
        )
        .select(
            *COLUMNS,
            F.col("latest.state").alias("state"),
            F.col("latest.rejected_at").alias("changed_at"),
        )
    )


def read(spark: SparkSession, path: str, *reasons: str) -> DataFrame:
    """The rows that are held now."""
    return read_states(spark, path, *reasons).where(F.col("state") == HELD).select(*COLUMNS)


def append_new(quarantined: DataFrame, path: str) -> None:
    """Adds a load's rows; nothing is read, and a repeated load counts once."""
    write(quarantined, path)


def change_state(
    rows: DataFrame, path: str, state: str, at: datetime | None = None, load_id: str | None = None
) -> None:
    """Marks rows of ``read`` as resolved or expired, without new copies."""
    stamp = F.current_timestamp() if at is None else F.lit(at)
    marked = rows.select(*IDENTITY, F.lit(0).cast("bigint").alias("copies"), stamp.alias("rejected_at"))
    write(marked.withColumns(_named(load_id, state)), path)


def expire(spark: SparkSession, path: str, before: datetime, at: datetime | None = None) -> None:
    """Gives up what came before a time and is still held; it is no longer retried."""
    old = read(spark, path).where(F.col("rejected_at") < F.lit(before))
    change_state(old, path, EXPIRED, at)


def replay(quarantined: DataFrame, source: str, *reasons: str) -> DataFrame:
    """The rows of one source as raw input again, each distinct row once."""
    rows = quarantined.where((F.col("source") == source) & F.col("raw_line").isNull())
    if reasons:
        rows = rows.where(F.col(REASON).isin(*reasons))
    parsed = F.from_json("payload", source_schema(source))
    return rows.select("payload").distinct().select(parsed.alias("row")).select("row.*")
