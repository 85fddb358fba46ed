"""Merging facts into their table, whatever the order in which repeats arrive.

Of all rows of one natural key the one of the least rank is the fact, in whichever load
or micro-batch it came.  A row enters the table if its key is new, if it ranks before
the stored row, or if it is held back and found its customer.  Its version is later than
the stored one's, so readers find it by version alone.  If the fact moves to another
place (tenant, day), or loses its customer, a withdrawn version stays at the old place.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.contracts import TableContract
from kinbridge.plans.validation import RANK
from kinbridge.sinks import keys, warehouse
from kinbridge.sinks.keys import KNOWN

MUST_RESOLVE = "must_resolve"
_RESOLVED = "canonical_customer_id IS NOT NULL"


def stamp(loaded_at: datetime | None) -> Column:
    given = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    return F.date_trunc("millisecond", given)


def later(loaded_at: datetime | None, than: Column) -> Column:
    """The time of the load, but after ``than``; a missing one does not matter."""
    return F.greatest(stamp(loaded_at), than + F.expr("INTERVAL '0.001' SECOND"))


def improving(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    facts: DataFrame,
    loaded_at: datetime | None = None,
    again: bool = False,
) -> DataFrame:
    """Those of unique ranked facts that the table lacks, with version and ``known``.

    ``again`` also gives rows that are stored in the same form.  Nothing is looked up in
    an empty index; the result then costs no more than ``facts``.
    """
    if keys.is_empty(spark, root, contract):
        nothing = F.lit(None).cast(warehouse.struct_of(keys.known_ddl(contract)))
        return _versioned(facts.withColumn(KNOWN, nothing), contract, loaded_at)
    found = keys.known(spark, root, contract, facts)
    rows = facts.join(found, list(contract.natural_key), "left")
    rank, stored = F.col(RANK), F.col(f"{KNOWN}.stored")
    # What is held back already, and still has no customer, is left as it is.
    equal = (rank <= F.col(f"{KNOWN}.rank")) & F.when(
        stored, F.lit(again)
    ).otherwise(F.expr(_RESOLVED))
    return _versioned(
        rows.where(F.col(KNOWN).isNull() | (rank < F.col(f"{KNOWN}.rank")) | equal),
        contract,
        loaded_at,
    )


def open_to_change(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    unique: DataFrame,
    rank: Column,
    keys_of: DataFrame,
    again: bool = False,
    keep_rank: bool = False,
) -> DataFrame:
    """Those of unique rows, still without customer, that ``improving`` may give.

    The index meets the rows where they were made unique, before they move to find their
    customer, so they need not be written in between.  ``keys_of`` has at least their
    keys, and should be a written table.  ``must_resolve`` marks rows held back already.
    ``keep_rank`` leaves the stored rank in ``known``, for ``signed``.
    """
    found = keys.known(spark, root, contract, keys_of)
    rows = unique.join(found, list(contract.natural_key), "left")
    known, stored = F.col(KNOWN), F.col(f"{KNOWN}.stored")
    better = F.coalesce(known.isNull() | (rank < known["rank"]), F.lit(False))
    equal = (rank <= known["rank"]) & F.when(stored, F.lit(again)).otherwise(F.lit(True))
    open_rows = rows.where(better | equal).withColumn(MUST_RESOLVE, ~better & ~stored)
    if keep_rank:
        return open_rows
    nothing = F.lit(None).cast(warehouse.struct_of(contract.rank))
    return open_rows.withColumn(KNOWN, known.withField("rank", nothing))


def with_customers_found(
    facts: DataFrame, contract: TableContract, loaded_at: datetime | None = None
) -> DataFrame:
    """Rows of ``open_to_change`` that the table lacks now that their customers are known,
    with version and ``known``."""
    waiting = F.coalesce(F.col(MUST_RESOLVE), F.lit(False))
    rows = facts.where(~waiting | F.expr(_RESOLVED)).drop(MUST_RESOLVE)
    return _versioned(rows, contract, loaded_at)


def _versioned(rows: DataFrame, contract: TableContract, loaded_at: datetime | None) -> DataFrame:
    return rows.withColumn(contract.version, later(loaded_at, F.col(f"{KNOWN}.version")))


def corrected(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    facts: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Stored facts in another form, with the rank they are stored under."""
    found = keys.known(spark, root, contract, facts)
    rows = facts.join(found, list(contract.natural_key), "left")
    return _versioned(rows.withColumn(RANK, F.col(f"{KNOWN}.rank")), contract, loaded_at)


def signed(taken: DataFrame, contract: TableContract, measure: str) -> DataFrame:
    """What rows of ``improving`` change in sums by place: minus the old, plus the new.

    (place, measure, facts); the measure must be part of the rank, which the index keeps.
    """
    one, was = F.lit(1).cast("bigint"), F.col(KNOWN)
    plus = taken.where(_RESOLVED).select(*contract.place, measure, one.alias("facts"))
    minus = taken.where(was["stored"]).select(
        *(was["place"][c].alias(c) for c in contract.place),
        (-was["rank"][measure]).cast(taken.schema[measure].dataType).alias(measure),
        (-one).alias("facts"),
    )
    return plus.unionByName(minus)


def commit(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    taken: DataFrame,
    path: str | None = None,
) -> None:
    """Stores rows of ``improving`` or ``corrected``; they should be a written table.

    Rows without a customer only withdraw what they replace.  If all rows lie in the table
    written to ``path``, table and index are laid out from there without a shuffle.
    """
    tasks = None if path is None else warehouse.tasks_for(spark, path)
    was, here = F.col(f"{KNOWN}.place"), keys.place(contract)
    left = F.col(f"{KNOWN}.stored") & (
        F.col("canonical_customer_id").isNull() | ~was.eqNullSafe(here)
    )
    withdrawn = taken.where(left).withColumns(
        {
            **{c: F.col(f"{KNOWN}.place.{c}") for c in contract.place},
            "canonical_customer_id": F.coalesce("canonical_customer_id", F.lit("")),
            warehouse.WITHDRAWN: F.lit(True),
        }
    )
    rows = taken.where(_RESOLVED).withColumn(warehouse.WITHDRAWN, F.lit(False))
    warehouse.append(rows.unionByName(withdrawn), root, contract, tasks=tasks)
    keys.add(
        spark,
        root,
        contract,
        taken.select(
            *contract.natural_key,
            RANK,
            F.col(contract.version).alias("version"),
            here.alias("place"),
            F.expr(_RESOLVED).alias("stored"),
        ),
        tasks,
    )
