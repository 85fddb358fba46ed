"""Facts laid out by tenant and day, and readers that open few files.

``cluster`` rewrites a table so that a file holds neighbouring tenants and days of one
month.  Both count alike: a tenant's code and the day of the month are interleaved bit by
bit, so a file is small in either direction.  A place with very many rows is cut by
customer and fills several files.

``describe`` writes the least and the greatest code and day of every file to a table of
its own, and ``read`` opens the files that may hold what it is asked for.  A file without
such a row is opened always, so rows that were appended since, or whose description was
lost, are never missed; rows of files that are gone do no harm.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge import workspace
from kinbridge.contracts import TableContract
from kinbridge.sinks import warehouse
from kinbridge.sinks.warehouse import MONTH, WITHDRAWN

#: Bits of a tenant's code and of a day of a month.
TENANT_BITS, DAY_BITS = 8, 5

SCHEMA = (
    "file string, code_from int, code_to int, day_from date, day_to date, rows bigint, ym string"
)


def ranges_path(root: str, contract: TableContract) -> str:
    return f"{root.rstrip('/')}/file_ranges/{contract.name}"


def tenant_code(tenant: Column | str) -> Column:
    return F.pmod(F.xxhash64(tenant), F.lit(2**TENANT_BITS)).cast("int")


def _interleaved(contract: TableContract) -> Column:
    """The bits of code and day in turn, highest first."""
    code, day = tenant_code("tenant"), F.dayofmonth(contract.month_of)
    places = sorted(
        [(place / TENANT_BITS, code, place) for place in range(TENANT_BITS)]
        + [(place / DAY_BITS, day, place) for place in range(DAY_BITS)],
        key=lambda bit: bit[0],
    )
    value = F.lit(0)
    for at, (_, number, place) in enumerate(places):
        bit = F.shiftright(number, place).bitwiseAND(F.lit(1))
        value = value.bitwiseOR(F.shiftleft(bit, at))
    return value


def laid_out(df: DataFrame, contract: TableContract, files: int | None = None) -> DataFrame:
    """Rows in ranges of month, interleaved place and customer.

    The ranges come from a sample of the rows, so ``df`` should be a written table.
    Without ``files`` adaptive execution merges ranges up to its advisory size, and
    ``spark.sql.shuffle.partitions`` bounds their number.
    """
    by = (F.col(MONTH), _interleaved(contract), F.xxhash64("canonical_customer_id"))
    return df.repartitionByRange(*by) if files is None else df.repartitionByRange(files, *by)


def cluster(
    spark: SparkSession, root: str, contract: TableContract, files: int | None = None
) -> str:
    """Compacts a fact table into ranges and describes its files; returns the copy's path."""
    copy = warehouse.compact(
        spark, root, contract, layout=lambda rows: laid_out(rows, contract, files)
    )
    describe(spark, root, contract)
    return copy


def _months(spark: SparkSession, root: str, contract: TableContract) -> list[str]:
    prefix = f"{MONTH}="
    found = workspace.children(spark, warehouse.table_path(root, contract))
    return [f.removeprefix(prefix) for f in found if f.startswith(prefix)]


def _files(spark: SparkSession, root: str, contract: TableContract, month: str) -> set[str]:
    folder = f"{MONTH}={month}"
    names = workspace.data_files(spark, f"{warehouse.table_path(root, contract)}/{folder}")
    return {f"{folder}/{name}" for name in names}


def described(spark: SparkSession, root: str, contract: TableContract) -> DataFrame:
    """The descriptions, of files that are gone too."""
    path = ranges_path(root, contract)
    workspace.make_folder(spark, path)
    return spark.read.schema(SCHEMA).parquet(path)


def describe(
    spark: SparkSession, root: str, contract: TableContract, months: list[str] | None = None
) -> None:
    """Describes the files that have no description yet, two columns of each.

    The driver holds the names of one month's files at a time, as any reader does.
    """
    for month in _months(spark, root, contract) if months is None else months:
        known = described(spark, root, contract).where(F.col(MONTH) == month).select("file")
        new = _files(spark, root, contract, month).difference(r["file"] for r in known.collect())
        if not new:
            continue
        path = warehouse.table_path(root, contract)
        reader = spark.read.option("basePath", path)
        rows = reader.schema(f"tenant string, {contract.month_of} date, {MONTH} string")
        named = rows.parquet(*(f"{path}/{f}" for f in sorted(new))).select(
            F.concat(F.lit(f"{MONTH}={month}/"), F.col("_metadata.file_name")).alias("file"),
            tenant_code("tenant").alias("code"),
            F.col(contract.month_of).alias("day"),
        )
        ranges = named.groupBy("file").agg(
            F.min("code").alias("code_from"),
            F.max("code").alias("code_to"),
            F.min("day").alias("day_from"),
            F.max("day").alias("day_to"),
            F.count(F.lit(1)).alias("rows"),
        )
        stored = ranges.withColumn(MONTH, F.lit(month)).repartition(1)
        stored.write.mode("append").partitionBy(MONTH).parquet(ranges_path(root, contract))


def files_for(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    first: date,
    last: date,
    tenant: str | None = None,
) -> list[str]:
    """The files that may hold rows of some days, of one tenant or of all."""
    wanted = [
        m
        for m in _months(spark, root, contract)
        if first.strftime("%Y%m") <= m <= last.strftime("%Y%m")
    ]
    outside = (F.col("day_to") < F.lit(first)) | (F.col("day_from") > F.lit(last))
    if tenant is not None:
        code = tenant_code(F.lit(tenant))
        outside = outside | (F.col("code_to") < code) | (F.col("code_from") > code)
    if not wanted:
        return []
    ranges = described(spark, root, contract).where(F.col(MONTH).isin(wanted) & outside)
    useless = {r["file"] for r in ranges.select("file").collect()}
    return sorted(f for m in wanted for f in _files(spark, root, contract, m) - useless)


def read(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    first: date,
    last: date,
    tenant: str | None = None,
) -> DataFrame:
    """The current rows of some days, of one tenant or of all, from as few files as possible.

    Only for tables with a key index: there every place holds all that decides on its
    rows, so files of other places are not needed.
    """
    if not warehouse.by_place(spark, root, contract, True):
        raise ValueError(f"{contract.name} has no key index, so its places depend on others")
    files = files_for(spark, root, contract, first, last, tenant)
    rows = warehouse.newest(spark, root, contract, files=files)
    rows = rows.where(F.col(contract.month_of).between(F.lit(first), F.lit(last)))
    if tenant is not None:
        rows = rows.where(F.col("tenant") == tenant)
    return rows.where(~F.coalesce(WITHDRAWN, F.lit(False))).drop(WITHDRAWN, MONTH)
