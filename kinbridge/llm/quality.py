"""Quality: a generalised additive model with pairwise interactions.

Each text is reduced to a few shape features.  Over a bounded sample of labelled rows
each feature is cut into bins, and cyclic boosting fits shallow trees on one feature at
a time; their leaves add up to one lookup table per feature.  The pairs of features
that explain most of what is left get two-dimensional tables in the same way.  A score
is the logistic of the intercept plus one table entry per feature and per pair.

Null texts count as empty, and an empty text has the feature values of zero words.
Repeated rows are scored alike, whole texts are read whatever their length, and columns
beside ``text`` are carried along untouched.  Without labelled rows of both kinds all
scores are the smoothed share of label 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm.common import training_rows

SAMPLE_ROWS = 20_000
BINS = 32
COARSE_BINS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.1
LEAF_L2 = 1.0
LEAF_ROWS = 5

FEATURES = (
    "log_words",
    "mean_word",
    "distinct_words",
    "top_word",
    "repeated_word",
    "short_words",
    "long_words",
    "symbols",
    "pipes",
    "upper",
    "digits",
    "stops",
    "exclamations",
    "log_lines",
    "words_per_line",
    "distinct_lines",
    "words_per_stop",
    "marked_words",
)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_SYMBOL = ~(_SPACE | _DIGIT | _LETTER)


def text_features(text: str) -> np.ndarray:
    """The values of ``FEATURES``, all finite."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if n == 0:
        return np.zeros(len(FEATURES))
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    solid = int(byte[~_SPACE].sum())
    length = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = sum(map(bytes.__eq__, words[1:], words[:-1]))
    last = Counter(w[-1] for w in words)
    stops = last[46] + last[33] + last[63]
    marked = sum(k for c, k in last.items() if _SYMBOL[c]) - stops - last[44]
    return np.array(
        [
            np.log1p(n),
            solid / n,
            len(counts) / n,
            max(counts.values()) / n,
            repeated / n,
            np.count_nonzero(length <= 3) / n,
            np.count_nonzero(length >= 12) / n,
            byte[_SYMBOL].sum() / solid,
            byte[124] / n,
            byte[_UPPER].sum() / solid,
            byte[_DIGIT].sum() / solid,
            stops / n,
            byte[33] / n,
            np.log1p(len(lines)),
            np.log1p(n / max(1, len(lines))),
            len(set(lines)) / max(1, len(lines)),
            np.log1p(n / (1 + stops)),
            marked / n,
        ]
    )


@dataclass
class Model:
    """Bin edges and tables: value of feature j in bin b is ``shapes[j][b]``."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    shapes: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, shape in enumerate(self.shapes):
            total += shape[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (i, j), t in zip(self.pairs, self.tables, strict=True):
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            b = np.searchsorted(self.coarse[j], x[:, j], side="right")
            total += t[a, b]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.margin(x))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins; place 0 is no cut."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    if not len(gl):
        return 0.0, 0
    gain = gl**2 / (hl + LEAF_L2) + gr**2 / (hr + LEAF_L2) - g.sum() ** 2 / (h.sum() + LEAF_L2)
    gain[(nl < LEAF_ROWS) | (nr < LEAF_ROWS)] = 0.0
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 0 else (0.0, 0)


def _shallow(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Step per bin from a tree of two levels on one feature."""
    step = np.zeros(len(g))
    _, mid = _cut(g, h, n)
    for lo, hi in ((0, mid), (mid, len(g))) if mid else ((0, len(g)),):
        _, cut = _cut(g[lo:hi], h[lo:hi], n[lo:hi])
        for a, b in ((lo, lo + cut), (lo + cut, hi)) if cut else ((lo, hi),):
            step[a:b] = -g[a:b].sum() / (h[a:b].sum() + LEAF_L2)
    return step


def _shallow_pair(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree that cuts the first feature, then the second on each side."""
    best, chosen = 0.0, np.zeros(g.shape)
    whole = g.sum() ** 2 / (h.sum() + LEAF_L2)
    for mid in range(1, g.shape[0]):
        gain, step = -whole, np.zeros(g.shape)
        for rows in (slice(0, mid), slice(mid, None)):
            gs, hs, ns = g[rows].sum(0), h[rows].sum(0), n[rows].sum(0)
            _, cut = _cut(gs, hs, ns)
            for cols in (slice(0, cut), slice(cut, None)) if cut else (slice(None),):
                gain += gs[cols].sum() ** 2 / (hs[cols].sum() + LEAF_L2)
                step[rows, cols] = -gs[cols].sum() / (hs[cols].sum() + LEAF_L2)
        if gain > best:
            best, chosen = gain, step
    return best, chosen


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    d = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(d)]
    model.coarse = [_edges(x[:, j], COARSE_BINS) for j in range(d)]
    model.shapes = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    sizes = [np.bincount(b, minlength=len(s)) for b, s in zip(bins, model.shapes, strict=True)]
    margin = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for j in range(d):
            p = _logistic(margin)
            k = len(model.shapes[j])
            g = np.bincount(bins[j], p - y, k)
            h = np.bincount(bins[j], p * (1 - p), k)
            step = RATE * _shallow(g, h, sizes[j])
            model.shapes[j] += step
            margin += step[bins[j]]

    wide = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    width = [len(e) + 1 for e in model.coarse]

    def grid(i: int, j: int, weight: np.ndarray) -> np.ndarray:
        flat = np.bincount(wide[i] * width[j] + wide[j], weight, width[i] * width[j])
        return flat.reshape(width[i], width[j])

    p, ones, found = _logistic(margin), np.ones(len(y)), []
    for i in range(d):
        for j in range(i + 1, d):
            gain, _ = _shallow_pair(grid(i, j, p - y), grid(i, j, p * (1 - p)), grid(i, j, ones))
            found.append((-gain, i, j))
    model.pairs = [(i, j) for gain, i, j in sorted(found)[:PAIRS] if gain < 0]
    model.tables = [np.zeros((width[i], width[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for t, (i, j) in zip(model.tables, model.pairs, strict=True):
            p = _logistic(margin)
            _, step = _shallow_pair(
                grid(i, j, p - y), grid(i, j, p * (1 - p)), grid(i, j, ones)
            )
            t += RATE * step
            margin += RATE * step[wide[i], wide[j]]
    return model


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> Model:
    """Fits on at most ``sample_rows`` labelled documents outside fold 0."""

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [text_features(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "x": x})

    rows = training_rows(docs, labels, "quality", sample_rows)
    sample = rows.mapInPandas(reduced, "doc_id long, y int, x array<double>").toPandas()
    sample = sample.sort_values("doc_id", kind="stable")
    x = np.array(sample["x"].tolist(), dtype=np.float64).reshape(len(sample), len(FEATURES))
    return fit(x, sample["y"].to_numpy(np.float64))


def with_score(spark: SparkSession, docs: DataFrame, model: Model, name: str) -> DataFrame:
    """The documents with a column of scores between 0 and 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = [text_features(t or "") for t in batch]
            x = np.array(x, dtype=np.float64).reshape(len(batch), len(FEATURES))
            yield pd.Series(shared.value.score(x))

    return docs.withColumn(name, score(F.col("text")))
