"""Reading, staging and drawing training rows, shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge import workspace

#: Rows a forced broadcast may hold at most; wider sides are joined by a shuffle.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back, which cuts lineage."""
    path = workspace.new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Marked for broadcast if its counted rows are few, else left to a shuffle join."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text (fold 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def first_by_hash(df: DataFrame, key: str, bound: int, n: int, seed: int = 0) -> DataFrame:
    """The ``bound`` rows whose key has the smallest hash; ``n`` is the number of rows.

    Rows that cannot be among them are left out before the sort, so no task and no merge
    of tasks sees much more than ``bound`` rows.
    """
    places = 1 << 30
    share = min(1.0, (1.2 * bound + 1000) / max(1, n))
    place = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(places))
    near = df.withColumn("_place", place).where(F.col("_place") <= int(share * places))
    return near.orderBy("_place", key).limit(bound).drop("_place")


def training_rows(docs: DataFrame, labels: DataFrame, target: str, bound: int) -> DataFrame:
    """Up to ``bound`` labelled documents outside fold 0: doc_id, y, text.

    The ids are the first by hash, so the draw is the same on every run.  Labels other
    than 0 and 1, null ids and ids labelled both ways are left out; of several documents
    with one id the smallest text is taken (null texts are empty).
    """
    known = (
        labels.select("doc_id", F.col(target).alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("other"))
        .where("y = other")
        .select("doc_id", "y")
    )
    drawn = first_by_hash(known, "doc_id", bound, known.count())
    # The broadcast side holds at most ``bound`` rows.
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
    )
