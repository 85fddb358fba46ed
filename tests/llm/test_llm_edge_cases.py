"""Every query of the corpus operators and the pipeline on empty and awkward tables."""

import math

import corpus_pipeline
import pytest
from corpus import tricky_documents, tricky_labels, write_tables

from kinbridge.llm.catalog import QUERIES

TABLES = {"op3_topk": "embeddings", "op6_vectors": "embeddings", "op9_warc": "pages"}

VECTORS = [
    (0, [1.0, 0.0, 0.5], 1),
    (0, [1.0, 0.0, 0.5], 1),
    (1, [1.0, 0.0, 0.5], 1),
    (2, [1.0, 0.01, 0.5], 1),
    (3, [0.0, 0.0, 0.0], 1),
    (4, None, 1),
    (5, [], 1),
    (6, [1.0, None, 0.5], 1),
    (7, [1.0, float("nan"), 0.5], 1),
    (8, [float("inf"), 0.0, 0.5], 1),
    (9, [1.0, 0.0], 1),
    (None, [1.0, 0.0, 0.5], 1),
    (100, [-1.0, 0.0, 2.5], None),
    (200, [3e38, -3e38, 3e38], 2),
    (300, [-0.0, 1e-40, 0.0], 2),
    (400, [1.0, 0.0], None),
]
PAGES = [
    (1, "http://a/1", "<p>" + "x" * 200),
    (2, "http://a/2", "<p>" + "x" * 200),
    (2, "http://a/2", "<p>" + "x" * 200),
    (3, None, "short"),
    (4, "http://a/4", "short"),
    (5, "http://a/\r\n5", None),
    (6, "", ""),
    (7, "http://a/7", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9),
    (8, "http://a/8", "WARC/1.1\r\n"),
    (None, "http://a/9", "<p>" + "y" * 200),
    (9, "http://a/9", "<p>" + "y" * 200),
    (None, None, None),
    (10, "http://a/10", "é" * 100_000),
]
CONVERSATIONS = [
    (1, 0, "user", "Hi."),
    (1, 0, "user", "Hi."),
    (1, None, None, None),
    (None, 1, "", ""),
    (2, 7, "assistant", "Long. " * 20_000),
]


def everything():
    return {**QUERIES, "pipeline": corpus_pipeline.run}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")))


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return write_tables(
        spark,
        str(tmp_path_factory.mktemp("awkward")),
        clashing=True,
        documents=tricky_documents(),
        labels=tricky_labels(),
        embeddings=VECTORS,
        pages=PAGES,
        conversations=CONVERSATIONS,
    )


@pytest.mark.parametrize("name", everything())
def test_empty_tables_give_no_rows(spark, empty, name):
    assert everything()[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", everything())
def test_awkward_rows(spark, awkward, name):
    rows = everything()[name](spark, awkward).collect()
    # No phrase of these texts occurs often enough.
    assert rows or name == "op11_phrases"
    if name == "op12_repair":
        assert sorted(str(r["conv_id"]) for r in rows) == ["1", "2", "None"]
    if name == "op13_main_text":
        texts = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in rows}
        assert len(rows) == len(PAGES)
        assert texts[2, "http://a/2"] == ("x" * 200, 200)
        assert texts[10, "http://a/10"] == ("é" * 100_000, 100_000)
        assert texts[None, None] == ("", 0)
    if name in ("op1_quality", "op7_toxicity"):
        assert len(rows) == len(tricky_documents())
        assert all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in rows)
        by_id = {}
        for r in rows:
            by_id.setdefault(r["doc_id"], set()).add(r["score"])
        assert by_id[3] == by_id[4]  # null and empty texts
        assert len(by_id[1]) == 1  # repeated rows
    if name in ("op2_mix", "op5_simhash", "op8_bpe", "op10_spans"):
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(
            str(r[0]) for r in tricky_documents()
        )
    if name == "op5_simhash":
        prints = {}
        for r in rows:
            prints.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
        assert {p for i in (3, 4, 5) for p, _ in prints[i]} == {"0" * 16}
        assert {c for i in (3, 4, 5) for _, c in prints[i]} == {3}
        assert prints[9][0] == prints[10][0]
    if name == "op6_vectors":
        found = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows)
        for vec in ("0", "1", "2", "None"):
            assert {(n, c) for v, n, c in found if v == vec} == {(4, "0")}
        assert len(found) == len(VECTORS)
        assert all(n == 0 and c == v for v, n, c in found if v in ("3", "4", "5", "6", "7", "100"))
    if name == "op9_warc":
        assert sorted(
            str((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"])) for r in rows
        ) == sorted(
            map(
                str,
                [
                    (1, 203, "response", None),
                    (2, 203, "revisit", 1),
                    (2, 203, "revisit", 1),
                    (3, 5, "response", None),
                    (4, 5, "response", None),
                    (5, 0, "response", None),
                    (6, 0, "response", None),
                    (7, len(PAGES[7][2]), "response", None),
                    (8, 10, "response", None),
                    (None, 203, "revisit", 9),
                    (9, 203, "response", None),
                    (None, 0, "response", None),
                    (10, 200_000, "response", None),
                ],
            )
        )


@pytest.mark.parametrize("name", ["op2_mix", "op1_quality", "op7_toxicity"])
def test_reruns_agree(spark, awkward, name):
    runs = [sorted(map(str, QUERIES[name](spark, awkward).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_all_but_the_last_stage_return_the_columns_of_documents(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, awkward).columns == docs.columns, name
