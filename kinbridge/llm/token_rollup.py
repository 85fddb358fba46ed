"""Token counts as rollups that are kept up to date by signed deltas.

A batch of changes inserts, deletes or revises the token counts of documents under a
tokenizer version.  It becomes signed rows, minus what the ledger holds for a changed
document and plus its new count, which are stored per document in a ledger and, added
up, as deltas by source, language and version.  Totals are the sums of the deltas.

A batch counts once its marker file exists, which is made as the last step, and such a
batch is not applied again.  A batch that was interrupted has no marker; what it had
written is not read, also not when the batch comes again, and is then overwritten.  Folders are
named by a hash of the batch, so a batch may have any name.

Of several changes of one document and version in a batch those of the greatest ``seq``
count (all, if they are equal); so of two revisions the later one does.  Null texts have 0
tokens; null sources and languages are groups of their own, and rows without id are one
document whose rows add up, as rows of one id do.  An insert of a stored document replaces it,
deletes and revisions of unknown ones act like deletes of nothing and inserts.  An empty
batch is committed and changes nothing.  Texts are counted whole, so the longest must fit a
task.  Only the columns named in ``apply`` are read, whatever else the rows hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm.bpe import parse_ranks, read_ranks

KEYS = ("source", "lang", "version")
CHANGE_KINDS = ("insert", "delete", "revise")

_LEDGER = "doc_id long, source string, lang string, version string, docs long, tokens long"
_DELTAS = "source string, lang string, version string, docs long, tokens long"


def token_count(spark: SparkSession, path: str, pattern: str, text: str = "text") -> Column:
    """Number of ordinary tokens of a whole text under a rank file."""
    shared = spark.sparkContext.broadcast(read_ranks(path))

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=parse_ranks(shared.value), special_tokens={}
        )
        for batch in texts:
            yield pd.Series([len(coder.encode_ordinary(t)) if t else 0 for t in batch], dtype="int64")

    return count(F.col(text))


def inserts(docs: DataFrame, tokens: Column, version: str) -> DataFrame:
    """Changes that insert every document under a tokenizer version."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        "lang",
        F.lit(version).alias("version"),
        tokens.alias("tokens"),
        F.lit("insert").alias("change"),
        F.lit(0).cast("long").alias("seq"),
    )


class Rollup:
    """Ledger, deltas and markers below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _name(self, batch: str) -> str:
        return "b" + hashlib.sha256(batch.encode()).hexdigest()[:32]

    def _path(self, kind: str, batch: str) -> str:
        return f"{self.root}/{kind}/batch={self._name(batch)}"

    def _files(self, path: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _names(self, kind: str) -> set[str]:
        """What lies in a folder: one listing, whatever the length of the history."""
        files, place = self._files(f"{self.root}/{kind}")
        if not files.exists(place):
            return set()
        return {s.getPath().getName() for s in files.listStatus(place)}

    def committed(self, batch: str) -> bool:
        files, marker = self._files(f"{self.root}/markers/{self._name(batch)}")
        return files.exists(marker)

    def _commit(self, batch: str) -> None:
        files, marker = self._files(f"{self.root}/markers/{self._name(batch)}")
        files.create(marker, True).close()

    def _read(self, kind: str, schema: str) -> DataFrame:
        """Rows of the batches that have a marker, by the same test as ``committed``."""
        written = {n.removeprefix("batch=") for n in self._names(kind) if n.startswith("batch=")}
        if not written:
            return self.spark.createDataFrame([], schema)
        unfinished = sorted(written - self._names("markers"))
        rows = self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.root}/{kind}")
        return rows.where(~F.col("batch").isin(unfinished)).drop("batch")

    def _stored(self, changed: DataFrame) -> DataFrame:
        """What the ledger holds for the changed documents."""
        ledger, keys = self._read("ledger", _LEDGER).alias("l"), changed.alias("k")
        same = F.col("l.doc_id").eqNullSafe(F.col("k.doc_id")) & (
            F.col("l.version") == F.col("k.version")
        )
        return (
            ledger.join(keys, same, "left_semi")
            .groupBy("doc_id", *KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 OR tokens <> 0")
        )

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Applies (doc_id, source, lang, version, tokens, change, seq) unless it was before."""
        if self.committed(batch):
            return False
        changes = changes.withColumn("doc_id", F.col("doc_id").cast("long"))
        if "seq" not in changes.columns:
            changes = changes.withColumn("seq", F.lit(0).cast("long"))
        changed = changes.groupBy("doc_id", "version").agg(F.max("seq").alias("last"))
        before = self._stored(changed).select(
            "doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")
        )
        same = F.col("c.doc_id").eqNullSafe(F.col("k.doc_id")) & (
            F.col("c.version") == F.col("k.version")
        )
        latest = changes.alias("c").join(
            changed.alias("k"), same & F.col("c.seq").eqNullSafe(F.col("k.last")), "left_semi"
        )
        after = latest.where(F.col("change").isin("insert", "revise")).select(
            "doc_id",
            *KEYS,
            F.lit(1).cast("long").alias("docs"),
            F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"),
        )
        ledger = self._path("ledger", batch)
        before.unionByName(after).write.mode("overwrite").parquet(ledger)
        signed = self.spark.read.schema(_LEDGER).parquet(ledger)
        signed.groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        ).write.mode("overwrite").parquet(self._path("deltas", batch))
        self._commit(batch)
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of all committed batches."""
        return (
            self._read("deltas", _DELTAS)
            .groupBy(*KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 OR tokens <> 0")
        )
