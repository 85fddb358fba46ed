"""The corpus pipeline: from raw documents to token ids, in five stages.

Every stage gets the documents its predecessor kept, all of them, and returns documents;
the last one returns their tokens.  ``run`` writes what a stage returns as Parquet below
the shared working folder and reads it back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm import bpe, mixing, sentence_spans, simhash, toxicity
from kinbridge.llm.common import staged, table
from kinbridge.session import configure

#: Pieces the tokenizer's workers remember; they share executors with earlier stages.
REMEMBERED = 60_000
#: Documents of this score and above are rejected.
TOXIC = 0.5
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    """A stage under the library's session settings."""

    @wraps(fn)
    def prepared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return fn(configure(spark), docs, sf_dir)

    return prepared


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("doc"), "text")
    scored = toxicity.with_score(spark, rows, model, "score")
    return scored.where(F.col("score") < TOXIC).select("doc.*")


@stage
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(spark, docs)


@stage
def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = sentence_spans.removed(docs, "removed_sentences").drop("removed_sentences")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
    return cut


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "source", "lang", "text")
    coded = bpe.with_tokens(spark, rows, RANKS, public_tokenizers.PATTERN, "coded", remember=REMEMBERED)
    return coded.select("doc_id", "source", "lang", "coded.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("substring_dedup", drop_repeated_spans),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Hashes, trained weights and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = staged(spark, step(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
