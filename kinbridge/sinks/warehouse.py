"""Warehouse tables as partitioned Parquet, appended and read keep-latest.

Every load appends rows stamped with a version; readers keep the newest version
per key.  A repeated load therefore changes no result, and a load that dies
leaves nothing visible, because Spark commits a write as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinbridge import workspace
from kinbridge.contracts import WAREHOUSE, TableContract
from kinbridge.operators import latest_version
from kinbridge.options import STRICT, Semantics

MONTH = "ym"
#: Customer ids, hashes in hexadecimal, are half as long with it as with the default.
CODEC = "zstd"
CUSTOMER = "canonical_customer_id"
#: Bytes of a written table that one task lays out in files of its own: at least, where
#: cores are free, and at most.  A task opens a file in every partition, which takes longer
#: than writing some 100 KB to it, and tables are laid out side by side.
LEAST_BYTES, TASK_BYTES = 48 << 20, 64 << 20
#: Marks a version that says a row is no longer at its place; readers never show it.
WITHDRAWN = "withdrawn"


def table_path(root: str, contract: TableContract) -> str:
    return f"{root.rstrip('/')}/{contract.name}"


def index_path(root: str, contract: TableContract) -> str:
    """Where the table's index of natural keys lies (see ``sinks.keys``)."""
    return f"{root.rstrip('/')}/key_index/{contract.name}"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def month_of(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMM")


def conform(
    df: DataFrame, contract: TableContract, loaded_at: datetime | Column | None = None
) -> DataFrame:
    """Contract columns in contract order and type, with the load version.

    The version defaults to the time of the load, one value for the whole load.
    """
    if contract.version not in df.columns:
        stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
        df = df.withColumn(contract.version, F.date_trunc("millisecond", stamp))
    return df.select(*(F.col(f.name).cast(f.dataType) for f in contract.schema.fields))


def contract_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """(column, rows): NULLs per column that must not hold any; one pass."""
    required = [f.name for f in contract.schema.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required))
    pairs = ", ".join(f"'{c}', {c}" for c in required)
    return counts.selectExpr(f"stack({len(required)}, {pairs}) AS (column_name, null_rows)").where(
        "null_rows > 0"
    )


def _physical(contract: TableContract) -> tuple[str, ...]:
    return contract.partition_by + ((MONTH,) if contract.month_of else ())


def _laid_out(df: DataFrame, contract: TableContract, tasks: int | None = None) -> DataFrame:
    """Even files per partition, sorted by the clustering key.

    The rebalance is a request, not a fixed layout: adaptive execution splits
    a month or system that holds most rows and merges small ones.  With ``tasks`` (see
    ``tasks_for``) nothing is shuffled and each task writes files of its own.
    """
    if contract.month_of:
        df = df.withColumn(MONTH, month_of(contract.month_of))
    partitions = _physical(contract)
    if tasks is None:
        df = unpacked(packed(df).hint("rebalance", *partitions)).select(*df.columns)
    else:
        df = df.coalesce(tasks)
    return df.sortWithinPartitions(*partitions, *contract.wide_key)


def tasks_for(spark: SparkSession, path: str) -> int:
    """How many tasks lay out the table written to ``path`` without a shuffle.

    A task has bytes enough to leave few files in every partition, and few enough to sort
    them in memory.  Large files are split, so a hot key's rows meet several tasks.
    """
    size = workspace.bytes_below(spark, path)
    free = min(spark.sparkContext.defaultParallelism, size // LEAST_BYTES)
    return max(1, free, -(-size // TASK_BYTES))


def packed(df: DataFrame) -> DataFrame:
    """Customer ids as bytes where that says the same, half as long in a shuffle."""
    short = F.unhex(CUSTOMER)
    exact = F.coalesce(F.lower(F.hex(short)) == F.col(CUSTOMER), F.lit(False))
    return df.withColumns(
        {"__short": F.when(exact, short), CUSTOMER: F.when(~exact, F.col(CUSTOMER))}
    )


def unpacked(df: DataFrame) -> DataFrame:
    """Undoes ``packed``."""
    text = F.coalesce(F.lower(F.hex("__short")), CUSTOMER)
    return df.withColumn(CUSTOMER, text).drop("__short")


def append(
    df: DataFrame,
    root: str,
    contract: TableContract,
    loaded_at: datetime | None = None,
    tasks: int | None = None,
) -> None:
    """Distributed load of one version; executors write, the driver only commits.

    ``tasks`` is for rows of a written table, see ``tasks_for``.
    """
    writer = _laid_out(_stored_form(df, contract, loaded_at), contract, tasks).write.mode("append")
    writer = writer.option("compression", CODEC).partitionBy(*_physical(contract))
    writer.parquet(table_path(root, contract))


def _stored_form(
    df: DataFrame, contract: TableContract, loaded_at: datetime | None
) -> DataFrame:
    """The contract's columns and the mark of withdrawn versions."""
    if WITHDRAWN not in df.columns:
        df = df.withColumn(WITHDRAWN, F.lit(False))
    if contract.version not in df.columns:
        stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
        df = df.withColumn(contract.version, F.date_trunc("millisecond", stamp))
    shaped = [F.col(f.name).cast(f.dataType) for f in contract.schema.fields]
    return df.select(*shaped, F.col(WITHDRAWN).cast("boolean"))


def append_to_database(
    df: DataFrame,
    url: str,
    contract: TableContract,
    loaded_at: datetime | None = None,
    *,
    connections: int = 8,
    batch_rows: int = 10_000,
    **options: str,
) -> None:
    """The same load into a database table over JDBC.

    Executors insert in batches over at most ``connections`` connections; the
    database must keep the newest version per key.  Needs the driver's jar.
    """
    (
        conform(df, contract, loaded_at)
        .write.format("jdbc")
        .mode("append")
        .options(url=url, dbtable=contract.name, **options)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .save()
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever written to ``path``; one call, no listing."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()).exists(location)


def create_tables(
    spark: SparkSession, root: str, contracts: Iterable[TableContract] = WAREHOUSE.values()
) -> None:
    """Makes every table readable; existing tables stay as they are."""
    for contract in contracts:
        workspace.make_folder(spark, table_path(root, contract))


def read_versions(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    months: tuple[str, str] | list[str] | None = None,
    withdrawn: bool = False,
    files: list[str] | None = None,
) -> DataFrame:
    """All stored versions; ``withdrawn`` adds the column that marks withdrawn ones.

    ``months`` prunes partitions: a tuple gives the first and last month as
    yyyyMM, a list names each month.  ``files`` names the only files to open, by
    their paths below the table.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in contract.schema.fields])
    if withdrawn:
        schema = schema.add(WITHDRAWN, "boolean")
    if contract.month_of:
        schema = schema.add(MONTH, "string")
    # The reader moves partition columns to the end; bring them back in order.
    path = table_path(root, contract)
    if files is None:
        df = spark.read.schema(schema).parquet(path)
    elif files:
        reader = spark.read.schema(schema).option("basePath", path)
        df = reader.parquet(*(f"{path}/{f}" for f in files))
    else:
        df = spark.createDataFrame([], schema)
    df = df.select(*schema.names)
    if months is None:
        return df
    if not contract.month_of:
        raise ValueError(f"{contract.name} is not partitioned by month")
    month = F.col(MONTH)
    return df.where(month.between(*months) if isinstance(months, tuple) else month.isin(months))


def months_in(df: DataFrame, instant: str) -> list[str]:
    """The calendar months a batch touches; at most one value per month."""
    month = month_of(instant).alias(MONTH)
    return [r[MONTH] for r in df.select(month).distinct().collect()]


def read_current(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    *,
    by_natural_key: bool = True,
    months: tuple[str, str] | list[str] | None = None,
) -> DataFrame:
    """The newest version of each logical row.

    A table with a key index is read place by place (see ``TableContract.place``): there
    a predicate on month, tenant or day reaches the scan below the choice of the version,
    and no two versions of a key are equal.  A table without one is read as a whole, equal
    versions are decided by all columns, and ``months`` is exact as long as no later
    version moves a row to another month.
    """
    rows = newest(spark, root, contract, by_natural_key=by_natural_key, months=months)
    return rows.where(~F.coalesce(WITHDRAWN, F.lit(False))).drop(WITHDRAWN, MONTH)


def newest(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    *,
    by_natural_key: bool = True,
    months: tuple[str, str] | list[str] | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """The newest version of each logical row, withdrawn or not.

    ``files`` must hold all versions of every place that is asked for.
    """
    versions = read_versions(spark, root, contract, months, withdrawn=True, files=files)
    key = list(contract.key(by_natural_key))
    if not by_place(spark, root, contract, by_natural_key):
        return latest_version(versions, key, contract.version)
    key = [*dict.fromkeys([MONTH, *contract.place, *key])]
    found = latest_version(packed(versions), key, contract.version, [])
    return unpacked(found).select(*versions.columns)


def register_views(spark: SparkSession, root: str, sem: Semantics = STRICT) -> None:
    """Current tables as views, for any SQL query.

    A predicate on the day of a fact prunes its month partitions.
    """
    for contract in WAREHOUSE.values():
        if by_place(spark, root, contract, sem.replace_by_natural_key):
            current = _with_calendar(spark, root, contract)
        else:
            current = read_current(spark, root, contract, by_natural_key=sem.replace_by_natural_key)
        current.createOrReplaceTempView(contract.name)


def by_place(
    spark: SparkSession, root: str, contract: TableContract, by_natural_key: bool
) -> bool:
    """Whether every place of a table can be read by itself: if it has a key index."""
    return by_natural_key and bool(contract.rank) and exists(spark, index_path(root, contract))


def calendar(spark: SparkSession, months: Iterable[str]) -> DataFrame:
    """(day, month) of all days of some months given as yyyyMM; made by tasks."""
    names = F.array(*map(F.lit, sorted(months)))
    days = F.explode(F.sequence("first", F.last_day("first")))
    return (
        spark.range(1)
        .select(F.explode(names).alias("month"))
        .select("month", F.to_date("month", "yyyyMM").alias("first"))
        .select("month", days.alias("day"))
    )


def _with_calendar(spark: SparkSession, root: str, contract: TableContract) -> DataFrame:
    """The current rows, joined with the days of the table's months.

    The join changes no row: every day occurs once.  But it takes a predicate on the day
    to the calendar, and the months that are left there to the scan, where they prune
    partitions, below the choice of the version.  The calendar has some thousand rows.
    """
    prefix = f"{MONTH}="
    found = workspace.children(spark, table_path(root, contract))
    months = [f.removeprefix(prefix) for f in found if re.fullmatch(rf"{prefix}\d{{6}}", f)]
    rows = newest(spark, root, contract).where(~F.coalesce(WITHDRAWN, F.lit(False)))
    if not months:
        return rows.drop(WITHDRAWN, MONTH)
    days = F.broadcast(calendar(spark, months))
    same = (F.col(contract.month_of) == F.col("day")) & (F.col(MONTH) == F.col("month"))
    return rows.join(days, same).drop(WITHDRAWN, MONTH, "day", "month")


def row_counts(spark: SparkSession, root: str, sem: Semantics = STRICT) -> DataFrame:
    """(table_name, row_count) of the current rows."""
    parts = [
        read_current(spark, root, c, by_natural_key=sem.replace_by_natural_key).agg(
            F.lit(c.name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for c in WAREHOUSE.values()
    ]
    return reduce(DataFrame.unionByName, parts)


def changed_rows(
    new: DataFrame, stored: DataFrame, contract: TableContract, loaded_at: datetime | None = None
) -> DataFrame:
    """Rows of ``new`` that ``stored`` (of ``newest``) does not hold in exactly this form.

    Their version is later than the stored one's, whatever the time of the load.
    """
    key = list(contract.natural_key)
    payload = F.struct(*(c for c in new.columns if c not in key))
    old = stored.select(
        *(F.col(c).alias(f"__{c}") for c in key),
        payload.alias("__old"),
        F.coalesce(WITHDRAWN, F.lit(False)).alias("__withdrawn"),
        F.col(contract.version).alias("__version"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    later = F.col("__version") + F.expr("INTERVAL '0.001' SECOND")
    return (
        new.join(old, same, "left")
        .where(F.col("__withdrawn").isNull() | F.col("__withdrawn") | ~payload.eqNullSafe(F.col("__old")))
        .withColumn(contract.version, F.greatest(F.date_trunc("millisecond", stamp), later))
        .select(*new.columns, contract.version)
    )


def compact(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    sem: Semantics = STRICT,
    layout: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Rewrites partitions with current rows only; returns the path of the copy.

    ``layout`` deals the rows out to files (see ``sinks.ranges``); otherwise the files
    are those of the copy.

    The current rows are first written to the shared working folder: a table is
    never overwritten by a plan that reads it, and the copy survives a crash.
    A partition whose rows all moved elsewhere keeps its superseded versions,
    which readers go on ignoring.
    """
    copy = workspace.new_folder(spark, f"compact-{contract.name}")
    partitions = _physical(contract)
    current = read_current(
        spark, root, contract, by_natural_key=sem.replace_by_natural_key
    )
    current = _laid_out(current.withColumn(WITHDRAWN, F.lit(False)), contract)
    current.write.option("compression", CODEC).partitionBy(*partitions).parquet(copy)
    kept = spark.read.schema(read_versions(spark, root, contract, withdrawn=True).schema)
    rows = kept.parquet(copy)
    rows = rows if layout is None else layout(rows)
    (
        rows.sortWithinPartitions(*partitions, *contract.wide_key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partitions)
        .parquet(table_path(root, contract))
    )
    return copy


def refresh_partitions(
    df: DataFrame, root: str, contract: TableContract, loaded_at: datetime | None = None
) -> None:
    """Replaces exactly the months (or systems) present in ``df``."""
    laid_out = _laid_out(_stored_form(df, contract, loaded_at), contract)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_physical(contract))
        .parquet(table_path(root, contract))
    )
