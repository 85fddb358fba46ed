"""Loading only what is new, and repairing what later input corrects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinbridge.plans.identity import APP


def not_loaded(batch: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not among the loaded rows.

    ``batch`` must hold each key once.  The history is first cut down to the
    keys of the batch: being the right side of a semi join, a small batch is
    broadcast by its measured size, so only key columns of the history are read
    and nothing of it is shuffled.  A large batch falls back to a sort-merge
    join.
    """
    keys = list(keys)
    repeated = (
        loaded.select(*keys).join(batch.select(*keys), keys, "left_semi").distinct()
    )
    return batch.join(repeated, keys, "left_anti")


def reidentified(current_facts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Activity facts whose customer the bridge now names differently.

    Appending them as a newer version replaces the old rows by natural key.
    Restrict ``current_facts`` to the months to repair.
    """
    now = bridge.where(F.col("source_system") == APP).select(
        F.col("source_customer_id").alias("app_customer_id"),
        "tenant",
        F.col("canonical_customer_id").alias("__now"),
    )
    moved = current_facts.join(now, ["app_customer_id", "tenant"]).where(
        F.col("__now") != F.col("canonical_customer_id")
    )
    return moved.withColumn("canonical_customer_id", F.col("__now")).select(
        *current_facts.columns
    )
