"""Phrase mining against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinbridge.llm import phrases

SCHEMA = "text string, lang string"


def plain(rows, least, top):
    """Every phrase counted, every longer one compared."""
    n, f = Counter(), Counter()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(upper, upper.lower()))):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        f[lang, tuple(words[i : i + k])] += 1
    frequent = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, words), a in frequent.items():
        inside = any(
            other == lang and len(q) > len(words) and f[other, q] >= a
            and any(q[i : i + len(words)] == words for i in range(len(q)))
            for other, q in frequent
        )
        if not inside:
            score, k = min(
                (1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k)
                for k in range(1, len(words))
            )
            parts = (f[lang, words[:k]], f[lang, words[k:]])
            found[lang].append((-score, -a, " ".join(words).encode(), *parts))
    return {
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, best in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1)
    }


def texts():
    rng = random.Random(1)
    words = ["a", "B", "é", "x\x01", "to", "of", "\x1c", "naïve", "Éa"]
    gaps = [" ", " ", "  ", "\t", ". ", "\n", ", ", "\x0b"]
    rows = [
        (
            "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60))),
            rng.choice(["en", "de", None, "und", ""]),
        )
        for _ in range(300)
    ]
    # Empty, null, repeated and long texts; one language holds most words.
    return rows + [(None, None), ("", "en"), rows[0], rows[0], ("a B to of zz " * 900, "en")]


@pytest.mark.parametrize("budget", [1_000_000, 300, 7])
def test_phrases_equal_plain_count(spark, monkeypatch, budget):
    if budget < 10:
        monkeypatch.setattr(phrases, "SLICE_WORDS", 50)
        monkeypatch.setattr(phrases, "PACKED", 5)
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in phrases.collocations(spark, docs, 8, 60, budget).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, 8, 60)


def test_a_phrase_is_dropped_only_for_an_equally_frequent_longer_one(spark):
    rows = [("new york city",)] * 9 + [("new york",)] * 3 + [("old town hall",)] * 9
    docs = spark.createDataFrame([(t, "en") for (t,) in rows], SCHEMA)
    got = {r.phrase: r.a for r in phrases.collocations(spark, docs, 8).collect()}
    assert got == {"new york": 12, "new york city": 9, "old town hall": 9}


def test_ties_are_ranked_by_bytes_of_the_phrase(spark):
    rows = [(f"{a} {b}", None) for a, b in (("z", "z1"), ("é", "é1"), ("~", "~1")) for _ in range(8)]
    got = phrases.collocations(spark, spark.createDataFrame(rows, SCHEMA), 8).orderBy("rank")
    assert [(r.lang, r.phrase) for r in got.collect()] == [
        ("und", "z z1"), ("und", "~ ~1"), ("und", "é é1"),
    ]


def test_products_beyond_64_bits_are_exact(spark):
    big = 3 * 10**12 + 7
    nodes = spark.createDataFrame(
        [("en", "a", big + 5), ("en", "b", big + 1), ("en", "a b", big)], phrases.COUNTS
    )
    languages = spark.createDataFrame([("en", 10**14 + 3)], "lang string, words long")
    (row,) = phrases.scored(nodes, languages).collect()
    assert row.score == 1000 * big * (10**14 + 3) // ((big + 5) * (big + 1))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(spark, empty).collect() == []
    rows = [("a b", "en", 1, "x", 2)] * 8
    docs = spark.createDataFrame(rows, f"{SCHEMA}, n long, phrase string, key long")
    assert [r.phrase for r in phrases.collocations(spark, docs, 8).collect()] == ["a b"]


def test_subtree_counts_are_sums_of_leaves():
    import pyarrow as pa

    words = pa.array([["a", "b"], ["a", "b", "c"], ["a", "d"], ["b"]])
    found = {}
    totals, tops = np.array([2, 3, 4, 5]), np.array([1, 1, 1, 1])
    for at, depth, sums in phrases.subtree_nodes(words, totals, tops, 1):
        for i, s in zip(at, sums):
            found[tuple(words[i].as_py()[:depth])] = s
    assert found == {("a",): 9, ("b",): 5, ("a", "b"): 5, ("a", "d"): 4, ("a", "b", "c"): 3}
