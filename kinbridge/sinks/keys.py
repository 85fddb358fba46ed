"""Index of the natural keys that a fact table has met.

One row per key and change: the rank of the key's survivor, the version and place under
which it is stored, or that it is held back.  A load asks the index, not the table, which
of its rows are new or better than what is known, so the history is neither scanned nor
shuffled: rows lie in buckets by the hash of their key, a load opens only the buckets
its keys fall into, and a small load names its hashes, so that the Bloom filters of
the files leave out most of these too.

The index is written after the rows it describes.  A load that dies in between stores
its rows once more when it is repeated, with the same values, and readers see them once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge import workspace
from kinbridge.contracts import TableContract
from kinbridge.functions import full_text, short_text
from kinbridge.plans.validation import RANK
from kinbridge.sinks import warehouse

HASH, BUCKET, KNOWN = "key_hash", "bucket", "known"
#: Buckets of a new index; a session may name another number under this key.
BUCKETS, BUCKETS_CONF = 32, "spark.kinbridge.keyBuckets"
#: Bits of the table that leaves out most of the index where few of its keys are wanted;
#: broadcast in words of 64.
BITS = 1 << 23
#: Keys a load may have for its hashes to be named in the filter.
FEW = 400


def _schema(contract: TableContract) -> str:
    columns = {f.name: f.dataType.simpleString() for f in contract.schema.fields}
    keys = "".join(f"{c} {columns[c]}, " for c in contract.natural_key)
    place = ", ".join(f"{c}: {columns[c]}" for c in contract.place)
    rank = warehouse.struct_of(contract.rank).simpleString()
    return (
        f"{keys}{HASH} bigint, rank {rank}, version timestamp, "
        f"place struct<{place}>, stored boolean"
    )


def known_ddl(contract: TableContract) -> str:
    """Fields of ``known``."""
    columns = {f.name: f.dataType.simpleString() for f in contract.schema.fields}
    place = ", ".join(f"{c}: {columns[c]}" for c in contract.place)
    rank = warehouse.struct_of(contract.rank).simpleString()
    return f"rank {rank}, age bigint, stored boolean, version timestamp, place struct<{place}>"


def key_hash(contract: TableContract) -> Column:
    return F.xxhash64(*contract.natural_key)


def place(contract: TableContract) -> Column:
    return F.struct(*contract.place)


def _buckets(spark: SparkSession, root: str, contract: TableContract) -> int:
    (name,) = workspace.children(spark, warehouse.index_path(root, contract))
    return int(name.removeprefix("of="))


def _folder(spark: SparkSession, root: str, contract: TableContract) -> str:
    buckets = _buckets(spark, root, contract)
    return f"{warehouse.index_path(root, contract)}/of={buckets}"


def make(spark: SparkSession, root: str, contract: TableContract) -> None:
    """Makes the index of a table; rows that were stored without one cannot be improved."""
    path = warehouse.index_path(root, contract)
    if warehouse.exists(spark, path):
        return
    buckets = int(spark.conf.get(BUCKETS_CONF, str(BUCKETS)))
    if not workspace.children(spark, warehouse.table_path(root, contract)):
        workspace.make_folder(spark, f"{path}/of={buckets}")
        return
    stored = warehouse.read_current(spark, root, contract).select(
        *contract.natural_key,
        F.lit(None).alias(RANK),
        F.col(contract.version).alias("version"),
        place(contract).alias("place"),
        F.lit(True).alias("stored"),
    )
    _write(stored, f"{path}/of={buckets}", contract, buckets)


def _write(
    rows: DataFrame, folder: str, contract: TableContract, buckets: int, tasks: int | None = None
) -> None:
    fields = warehouse.struct_of(_schema(contract)).fields
    names = [f.name for f in fields]
    shaped = rows.withColumnRenamed(RANK, "rank")
    typed = shaped.select(*(F.col(f.name).cast(f.dataType) for f in fields if f.name != HASH))
    dealt = typed.withColumn("rank", _with_texts(contract, short_text)).withColumn(
        BUCKET, F.pmod(key_hash(contract), F.lit(buckets)).cast("int")
    )
    dealt = dealt.hint("rebalance", BUCKET) if tasks is None else dealt.coalesce(tasks)
    # The hash is made anew after the shuffle, which it would only swell.
    (
        dealt.withColumn(HASH, key_hash(contract))
        .select(*names, BUCKET)
        .sortWithinPartitions(BUCKET, HASH)
        .write.mode("append")
        .option("compression", warehouse.CODEC)
        .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")  # as large as the file needs
        .partitionBy(BUCKET)
        .parquet(folder)
    )


def _with_texts(contract: TableContract, change: Callable[[Column, Column], Column]) -> Column:
    """The rank with its texts in another form; they are short in files and shuffles."""
    rank = given = F.col("rank")
    for text, at in contract.rank_texts:
        rank = rank.withField(text, change(given[text], given[at]))
    return rank


def is_empty(spark: SparkSession, root: str, contract: TableContract) -> bool:
    return not workspace.children(spark, _folder(spark, root, contract))


def add(
    spark: SparkSession,
    root: str,
    contract: TableContract,
    rows: DataFrame,
    tasks: int | None = None,
) -> None:
    """Records (natural key, rank, version, place, stored) of a load.

    ``tasks`` is for rows of a written table, see ``warehouse.tasks_for``.
    """
    folder = _folder(spark, root, contract)
    _write(rows, folder, contract, _buckets(spark, root, contract), tasks)


def read(
    spark: SparkSession, root: str, contract: TableContract, keys: DataFrame
) -> DataFrame:
    """The part of the index in which ``keys`` may be."""
    buckets = _buckets(spark, root, contract)
    schema = warehouse.struct_of(f"{_schema(contract)}, {BUCKET} int")
    stored = spark.read.schema(schema).parquet(_folder(spark, root, contract))
    hashes = keys.select(key_hash(contract).alias(HASH))
    # Repeats count too, so that no task has to meet another to know that there are many.
    found = [r[HASH] for r in hashes.limit(FEW + 1).collect()]
    if len(found) <= FEW:
        few = sorted(set(found))
        return stored.where(F.col(BUCKET).isin(sorted({h % buckets for h in few}))).where(
            F.col(HASH).isin(few)
        )
    bucket = F.pmod(HASH, F.lit(buckets)).cast("int").alias(BUCKET)
    touched = [r[BUCKET] for r in hashes.select(bucket).distinct().collect()]
    return stored if len(touched) == buckets else stored.where(F.col(BUCKET).isin(touched))


def _near(stored: DataFrame, keys: DataFrame, contract: TableContract) -> DataFrame:
    """Rows of the index whose hash falls on a bit that one of ``keys`` has set.

    The bits are broadcast, at most ``BITS / 64`` words, so rows of other keys are left
    out where they are read.  Some pass by chance: a join by the keys must follow.
    """
    word, bit = F.lit(64), F.pmod(HASH, F.lit(BITS))
    wanted = (
        keys.select(key_hash(contract).alias(HASH))
        .select(F.floor(bit / word).alias("word"), F.pmod(bit, word).cast("int").alias("at"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
    )
    hit = (F.floor(bit / word) == F.col("word")) & (F.getbit("bits", F.pmod(bit, word)) == 1)
    # As a semi join it stays below the one by the keys.
    return stored.join(F.broadcast(wanted), hit, "left_semi")


def known(
    spark: SparkSession, root: str, contract: TableContract, keys: DataFrame, brief: bool = False
) -> DataFrame:
    """(natural key, known) of those ``keys`` the index has; ``brief`` leaves out version
    and place, and is for keys that are few beside the index.

    ``known`` holds stored, rank, version and place of the best row, the newest of equal
    ones.  A missing rank comes first: nothing is better than a row without one.
    """
    key = list(contract.natural_key)
    newest_first = (-F.unix_micros("version")).alias("age")
    rest = () if brief else ("version", "place")
    best = F.min(F.struct("rank", newest_first, "stored", *rest))
    stored = read(spark, root, contract, keys)
    if brief:
        stored = _near(stored, keys, contract)
    found = stored.join(keys.select(*key), key, "left_semi")
    found = found.withColumn("rank", _with_texts(contract, full_text))
    return found.groupBy(*key).agg(best.alias(KNOWN))
