"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

A text is lower-cased; every run of 5 and of 6 characters is hashed into one of
``BUCKETS`` features, present or absent.  Over a bounded sample of labelled rows the
features get a log ratio of their shares in toxic and in other texts; those whose
ratio stands out from its sampling error stay.  A logistic regression is fitted on the
scaled features (feature times ratio), and a text's score is the logistic of the sum.

Null texts count as empty.  A text of fewer than 5 characters has no features and
gets the score of the intercept.  Repeated rows are scored alike.  Without labelled rows of both kinds the
score is the smoothed share of toxic rows (0.5 / 1 of none).  Whole texts are read,
whatever their length, and columns beside ``text`` are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm.common import training_rows

BUCKETS = 1 << 20
SAMPLE_ROWS = 12_000
#: A ratio must exceed its standard error this many times.
SIGNIFICANCE = 3.0
FEATURES = 8192
SMOOTHING = 1.0
L2 = 0.5
#: Present features that the fit unpacks at a time, and how they are packed; numbers below
#: ``FEATURES`` must fit.
PART, PACKED = 1 << 18, np.dtype("<u2")

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_2 = np.uint64(0x9E3779B97F4A7C15**2 % 2**64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def ngram_buckets(text: str) -> np.ndarray:
    """Feature number of every run of 5 and of 6 characters, repeats included."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = c.astype(np.uint64)
    if len(c) < 5:
        return np.empty(0, np.int64)
    two = c[:-1] * _BASE + c[1:]
    four = two[:-2] * _BASE_2 + two[2:]
    five = four[:-1] * _BASE + c[4:]
    six = five[:-1] * _BASE + c[5:]
    runs = np.concatenate((five, six))
    runs ^= runs >> np.uint64(29)
    runs *= _MIX
    return (runs >> np.uint64(44)).astype(np.int64)


@dataclass
class Model:
    """Intercept, and weight times ratio of the features that stayed."""

    intercept: float
    features: np.ndarray
    weights: np.ndarray

    def table(self) -> np.ndarray:
        dense = np.zeros(BUCKETS, np.float64)
        dense[self.features] = self.weights
        return dense


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def score_text(text: str, intercept: float, table: np.ndarray) -> float:
    runs = ngram_buckets(text)
    present = np.unique(runs[table[runs] != 0])
    return float(_logistic(intercept + table[present].sum()))


def _class_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros((2, BUCKETS), np.int32)
    for batch in batches:
        for text, y in zip(batch["text"], batch["y"], strict=True):
            counts[int(y)][np.unique(ngram_buckets(text))] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"feature": seen, "neg": counts[0][seen], "pos": counts[1][seen]})


def _ratios(spark: SparkSession, rows: DataFrame) -> pd.DataFrame:
    """Features that stand out, with their log ratio; summed by Spark, at most FEATURES."""
    counts = (
        rows.mapInPandas(_class_counts, "feature long, neg int, pos int")
        .groupBy("feature")
        .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    )
    totals = counts.agg(
        F.sum(F.col("neg") + SMOOTHING).alias("q"), F.sum(F.col("pos") + SMOOTHING).alias("p")
    ).first()
    if not totals["p"] or not totals["q"]:
        return pd.DataFrame({"feature": [], "ratio": []})
    ratio = F.log((F.col("pos") + SMOOTHING) / totals["p"]) - F.log(
        (F.col("neg") + SMOOTHING) / totals["q"]
    )
    error = F.sqrt(1 / (F.col("pos") + SMOOTHING) + 1 / (F.col("neg") + SMOOTHING))
    kept = (
        counts.select("feature", ratio.alias("ratio"), (F.abs(ratio) / error).alias("z"))
        .where(F.col("z") > SIGNIFICANCE)
        # At most BUCKETS rows; few tasks, as each sends its FEATURES best to the driver.
        .coalesce(4)
        .orderBy(F.desc("z"), "feature")
        .limit(FEATURES)
    )
    return kept.select("feature", "ratio").toPandas().sort_values("feature")


def _fit(
    cols: np.ndarray, sizes: np.ndarray, y: np.ndarray, ratio: np.ndarray
) -> tuple[float, np.ndarray]:
    """Weights of a logistic regression on the present features times their ratios.

    ``cols`` has the features of all rows one after the other, ``sizes`` their numbers.
    Every step goes over parts of the rows, so besides ``cols`` only one part is in memory;
    sums are taken in the order of the rows, whatever the parts.
    """
    n, d = len(sizes), len(ratio)
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
    cuts = [0]
    while cuts[-1] < n:
        full = np.searchsorted(ends, ends[cuts[-1]] + PART, side="right") - 1
        cuts.append(max(cuts[-1] + 1, int(full)))

    def parts() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for a, b in pairwise(cuts):
            doc = np.repeat(np.arange(b - a), sizes[a:b])
            yield slice(a, b), doc, cols[ends[a] : ends[b]].astype(np.int64)

    share = (y.sum() + 0.5) / (len(y) + 1)
    b, w = float(np.log(share / (1 - share))), np.zeros(d)
    # Accelerated gradient steps, each feature scaled by a bound on its curvature.
    row_mass, curve = np.empty(n), np.zeros(d)
    for rows, doc, col in parts():
        size = np.abs(ratio[col])
        row_mass[rows] = np.bincount(doc, size, rows.stop - rows.start) + 1.0
        np.add.at(curve, col, size * row_mass[rows][doc])
    curve = 0.25 * curve + L2
    curve_b = 0.25 * row_mass.sum()
    vw, vb, t = w.copy(), b, 1.0
    pull = np.empty(n)
    for _ in range(600):
        slope, scaled = np.zeros(d), ratio * vw
        for rows, doc, col in parts():
            margin = vb + np.bincount(doc, scaled[col], rows.stop - rows.start)
            pull[rows] = _logistic(margin) - y[rows]
            np.add.at(slope, col, ratio[col] * pull[rows][doc])
        new_w = vw - (slope + L2 * vw) / curve
        new_b = vb - pull.sum() / curve_b
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw = new_w + (t - 1) / t_next * (new_w - w)
        vb = new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return b, w


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fits on at most ``sample_rows`` labelled documents outside fold 0."""
    rows = training_rows(docs, labels, "toxic", sample_rows).persist()
    ratios = _ratios(spark, rows)
    features = ratios["feature"].to_numpy(np.int64)
    ratio = ratios["ratio"].to_numpy(np.float64)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.full(BUCKETS, -1, np.int32)
        place[features] = np.arange(len(features))
        for batch in batches:
            cols = [np.unique(place[ngram_buckets(t)]) for t in batch["text"]]
            packed = [c[c >= 0].astype(PACKED).tobytes() for c in cols]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "cols": packed})

    # At most sample_rows lists of present features, two bytes each; a list is long where
    # texts share very common passages.
    sample = rows.mapInPandas(present, "doc_id long, y int, cols binary").toPandas()
    rows.unpersist()
    sample = sample.sort_values("doc_id", kind="stable")
    y = sample["y"].to_numpy(np.float64)
    if not len(features) or y.min(initial=1) == y.max(initial=0):
        share = (y.sum() + 0.5) / (len(y) + 1)
        none = np.empty(0)
        return Model(float(np.log(share / (1 - share))), none.astype(np.int64), none)
    sizes = sample["cols"].map(len).to_numpy(np.int64) // PACKED.itemsize
    cols = np.frombuffer(b"".join(sample.pop("cols")), PACKED)
    b, w = _fit(cols, sizes, y, ratio)
    return Model(b, features, w * ratio)


def with_score(spark: SparkSession, docs: DataFrame, model: Model, name: str) -> DataFrame:
    """The documents with a column of scores between 0 and 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        intercept, weights = shared.value.intercept, shared.value.table()
        for batch in texts:
            yield pd.Series([score_text(t or "", intercept, weights) for t in batch], dtype=float)

    return docs.withColumn(name, score(F.col("text")))
