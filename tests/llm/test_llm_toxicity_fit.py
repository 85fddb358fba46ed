"""The classifier's fit in the driver: bounded memory, sums that do not depend on parts."""

import random
import tracemalloc

import numpy as np
from corpus import prose

from kinbridge.llm import toxicity


def test_fit_does_not_depend_on_its_parts(monkeypatch):
    rng = np.random.default_rng(5)
    rows = [np.flatnonzero(rng.random(40) < 0.3 * (i % 5 > 0)) for i in range(60)]
    sizes = np.array([len(r) for r in rows])
    cols = np.concatenate(rows).astype(toxicity.PACKED)
    y, ratio = (rng.random(60) < 0.4).astype(float), rng.normal(size=40)
    whole = toxicity._fit(cols, sizes, y, ratio)
    # The same steps on a dense table.
    dense = np.zeros((60, 40))
    for i, r in enumerate(rows):
        dense[i, r] = ratio[r]
    b, w = whole
    pull = toxicity._logistic(b + dense @ w) - y
    assert abs(pull.sum()) < 1e-3 and np.abs(dense.T @ pull + toxicity.L2 * w).max() < 1e-3
    for part in (1, 7, 100):
        monkeypatch.setattr(toxicity, "PART", part)
        again = toxicity._fit(cols, sizes, y, ratio)
        assert again[0] == whole[0] and (again[1] == whole[1]).all()


def test_fit_stays_small_where_texts_share_a_long_passage(spark):
    """Every toxic text has thousands of features; the driver holds two bytes of each."""
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=2000))
    docs = [(i, (passage if i % 2 else "") + prose(rng, 4)) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    tracemalloc.start()
    model = toxicity.train(spark, frame, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.features) > 3000
    assert peak < 20e6, peak
