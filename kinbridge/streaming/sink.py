"""Sinks that give the same tables however often a batch is replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kinbridge import workspace
from kinbridge.contracts import BRIDGE, FACT_ACTIVITY
from kinbridge.plans import facts
from kinbridge.plans.validation import (
    accepted_events,
    event_rank,
    rejected,
    unique_events,
)
from kinbridge.sinks import keys, merge, quarantine, warehouse
from kinbridge.streaming.activity import SOURCE, LateRows

BATCH = "batch_id"
FEE = "platform_fee_usdt"


def write_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Each micro-batch replaces its own folder, so a retry leaves no repeats."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def run_available(
    writer: DataStreamWriter, name: str | None = None, late: LateRows | None = None
) -> StreamingQuery:
    """Processes what is there and stops; ``late`` counts the late rows of all batches."""
    if name:
        writer = writer.queryName(name)
    query = writer.trigger(availableNow=True).start()
    if late is not None:
        while not query.awaitTermination(0.5):
            late.update(query)
        late.update(query)
    query.awaitTermination()
    return query


def run_continuously(writer: DataStreamWriter, every: str = "30 seconds") -> StreamingQuery:
    """Sub-minute micro-batches until stopped."""
    return writer.trigger(processingTime=every).start()


def load_warehouse(
    labelled: DataFrame,
    root: str,
    quarantine_path: str,
    checkpoint: str,
    name_of_stream: str = "stream",
    changes_path: str | None = None,
) -> DataStreamWriter:
    """The whole activity path per micro-batch, straight into the warehouse.

    The table's key index is the memory: a batch is reduced to one row per natural
    key before its shuffle and then merged by rank (see ``sinks.merge``), so repeats are
    caught and better ones win however late they come, and no streaming state
    grows.  A batch is computed once, into the shared folder.  The bridge is read anew
    for each batch and hence never stale.  Batches are known by the stream's name and
    their number; rejected rows of a batch that comes again count once.

    With ``changes_path`` every batch publishes what it changes in the fees by tenant and
    day, as signed rows that ``daily_fee_of_changes`` adds up.

    ``quarantine_path`` may be the table of the batch loads, which then retry the
    events that are held for an unknown customer.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = workspace.new_folder(spark, "micro-batch")
        rows = _staged(batch, f"{stage}/labelled")
        keys.make(spark, root, FACT_ACTIVITY)
        bridge = warehouse.read_current(spark, root, BRIDGE)
        good, rank, path = accepted_events(rows), event_rank(), f"{stage}/taken"
        if keys.is_empty(spark, root, FACT_ACTIVITY):
            found = facts.ranked_activity(unique_events(good), bridge)
            taken = merge.improving(spark, root, FACT_ACTIVITY, _staged(found, path))
        else:
            key = good.select(*FACT_ACTIVITY.natural_key)
            opened = merge.open_to_change(
                spark, root, FACT_ACTIVITY, unique_events(good), rank, key, keep_rank=True
            )
            found = facts.ranked_activity(opened, bridge, keys.KNOWN, merge.MUST_RESOLVE)
            taken = _staged(merge.with_customers_found(found, FACT_ACTIVITY), path)
        # Quarantine first: a retry after the commit below finds nothing new.
        name = f"{name_of_stream}-{batch_id}"
        held = quarantine.held_events(facts.unresolved(taken))
        bad = quarantine.as_quarantine(rejected(rows), SOURCE, load_id=name).unionByName(
            quarantine.as_quarantine(held, SOURCE, load_id=name)
        )
        quarantine.make_table(spark, quarantine_path)
        quarantine.append_new(bad, quarantine_path)
        if changes_path is not None:
            _publish(merge.signed(taken, FACT_ACTIVITY, FEE), f"{changes_path}/{name}")
        merge.commit(spark, root, FACT_ACTIVITY, taken)
        workspace.remove(spark, stage)

    return _foreach(labelled, checkpoint, load)


def _publish(changes: DataFrame, path: str) -> None:
    """Writes a batch's changes once: a retry before the commit finds them there."""
    if not warehouse.exists(changes.sparkSession, f"{path}/_SUCCESS"):
        changes.write.mode("overwrite").parquet(path)


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", warehouse.CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _foreach(
    stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
    )
