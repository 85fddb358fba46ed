"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int"
PAGES = "page_id long, url string, html string"
CONVERSATIONS = "conv_id long, turn long, role string, text string"
#: Columns that operators use inside, as columns of the given tables.
CLASHING = "score double, size long, key long, print long, doc string, place long, rep long, h long"
CLASHING_VALUES = (0.5, 1, 2, 3, "x", 4, 5, 6)

SCHEMAS = {
    "documents": DOCUMENTS,
    "labels": LABELS,
    "embeddings": VECTORS,
    "pages": PAGES,
    "conversations": CONVERSATIONS,
}


def write_tables(spark: SparkSession, folder: str, clashing: bool = False, **rows) -> str:
    """Writes the given rows, and empty tables for the others; returns the folder."""
    for name, schema in SCHEMAS.items():
        given = rows.get(name, [])
        if clashing:
            schema = f"{schema}, {CLASHING}"
            given = [(*r, *CLASHING_VALUES) for r in given]
        frame = spark.createDataFrame(given, schema)
        frame.coalesce(3).write.parquet(f"{folder}/{name}.parquet")
    return folder


def sentence(rng: random.Random, words: int) -> str:
    letters = "abcdefghijklmnoprstuvwz"
    found = ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(words)]
    return " ".join(found).capitalize() + "."


def prose(rng: random.Random, sentences: int) -> str:
    return " ".join(sentence(rng, rng.randint(4, 14)) for _ in range(sentences))


def tricky_documents() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    shared = prose(rng, 8)
    long_text = prose(rng, 4000)
    rows = [
        (1, shared, "en", "a", 1),
        (1, shared, "en", "a", 1),
        (2, "Own start of it. " + shared + " And an end.", "en", "a", 2),
        (3, None, None, None, None),
        (4, "", "en", "", 0),
        (5, " \t\n\v\f\r ", "de", "b", 3),
        (None, "Text without an id. " + prose(rng, 5), "fr", "b", 4),
        (None, None, None, None, None),
        (6, long_text, "en", "c", len(long_text)),
        (6, prose(rng, 3), "en", "c", 5),
        (7, "é \x1c \U0001f600 \x00 'll   x 123", "xx", "é", 6),
        (8, "a" * 3000, "en", "zz", 3000),
        (9, "one two three", "en", "zz", 13),
        (10, "one two three", "en", "zz", 13),
        (-11, "WARC/1.1\r\n one", "en", "b", 7),
    ]
    rows += [(100 + i, prose(rng, 6), "en", "abc"[i % 3], 8) for i in range(40)]
    return rows


def tricky_labels() -> list[tuple]:
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, 1), (3, None, None), (None, 1, 1), (4, 0, 0), (99, 1, 1)]
    return rows + [(100 + i, i % 2, int(i % 4 == 0)) for i in range(40)]
