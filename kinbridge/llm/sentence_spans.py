"""Substring dedup by sliding spans of sentences.

A sentence ends after . ! or ? before white space, or at a line end.  Where ``WINDOW``
words follow each other without such an end, the text is also cut after the first of those
with the smallest hash, so every ``WINDOW`` words hold a cut that depends on nothing but
them.  Any 51 words that two texts share are therefore cut alike from a cut among the first
12 to one among the last 13, which leaves at least 3 sentences and 27 words between.  From
every sentence on, and up to every sentence, the shortest run of at least ``SENTENCES``
sentences and ``WORDS`` words is a span.  Spans are compared
by 96-bit hashes of their words over all documents.  The occurrences in the smallest id
are first, and there the first one in the text; sentences covered by any other occurrence
are removed with the white space after them.

Null texts stay null, texts without spans stay as they are, and a text of which all
sentences are removed becomes empty; every row stays.  Different texts with one id or
without id are different documents, in the order of their hashes; rows with the same id
and text are one.  Null ids come before all others.  Other columns are carried along
untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinbridge.llm.common import staged

SENTENCES = 3
WORDS = 25
#: So many words hold a cut at least; 4 windows and 3 words are the shared words that are found.
WINDOW = 12

_END = re.compile(r"[.!?]+\s+|\n\s*")
_WORD_AND_SPACE = re.compile(r"\S+\s*")
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def _picked(words: list[str]) -> list[int]:
    """The first word of least hash in every window, in order; the last word ends a sentence."""
    hashed = [crc32(w.encode("utf-8", "surrogatepass")) for w in words[:-1]]
    picks, at = [], -1
    for start in range(len(hashed) - WINDOW + 1):
        end = start + WINDOW - 1
        if at < start:
            window = hashed[start : end + 1]
            at = start + window.index(min(window))
        elif hashed[end] < hashed[at]:
            at = end
        else:
            continue
        picks.append(at)
    return picks


def split(text: str) -> tuple[list[str], list[list[str]]]:
    """The text in consecutive parts, white space after a sentence included, and their words."""
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    parts, words, at = [], [], 0
    for end in ends:
        part = text[at:end]
        at = end
        own = part.split()
        if len(own) <= WINDOW:
            if part:
                parts.append(part)
                words.append(own)
            continue
        behind = [m.end() for m in _WORD_AND_SPACE.finditer(part)]
        start = first = 0
        for i in _picked(own):
            parts.append(part[start : behind[i]])
            words.append(own[first : i + 1])
            start, first = behind[i], i + 1
        parts.append(part[start:])
        words.append(own[first:])
    return parts, words


def sentences(text: str) -> list[str]:
    return split(text)[0]


@lru_cache(maxsize=64)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spans(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and behind-last sentence and two hashes of every span, in order of the text."""
    n = len(words)
    before = np.zeros(n + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, n), out=before[1:])
    at = np.arange(n)
    # Shortest spans from every sentence, and up to every sentence.
    behind = np.maximum(at + SENTENCES, np.searchsorted(before, before[:-1] + WORDS))
    ends = at + 1
    start = np.minimum(
        ends - SENTENCES, np.searchsorted(before, before[1:] - WORDS, side="right") - 1
    )
    on, up = behind <= n, start >= 0
    code = np.unique(
        np.concatenate((at[on] * (n + 1) + behind[on], start[up] * (n + 1) + ends[up]))
    )
    first, last = code // (n + 1), code % (n + 1)
    if not len(code):
        return first, last, first, first
    hashed = xxhash.xxh3_128_digest
    joined = b"".join([hashed(" ".join(w).encode("utf-8", "surrogatepass")) for w in words])
    both = np.frombuffer(joined, np.uint64).reshape(n, 2)
    size = 1 << n.bit_length()
    hashes = []
    for i, (base, inverse) in enumerate(zip(_BASES, _INVERSES, strict=True)):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(both[:, i] * _powers(base, size)[:n], out=total[1:])
        mixed = (total[last] - total[first]) * _powers(inverse, size)[first]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        hashes.append(mixed)
    return first, last, hashes[0].view(np.int64), (hashes[1] >> np.uint64(32)).view(np.int64)


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sentences that spans in order of the text cover, as few ranges as possible."""
    if not len(first):
        return first, last
    reach = np.maximum.accumulate(last)
    new = np.append(True, first[1:] > reach[:-1])
    return first[new], reach[np.append(new[1:], True)]


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["h", "g", "doc_id", "mark", "place", "again"]
    for batch in batches:
        cols: list[list[np.ndarray]] = [[] for _ in names[:2]]
        rows, places, repeats = [], [], []
        for i, text in enumerate(batch.column("text")):
            words = split(text.as_py() or "")[1]
            if len(words) < SENTENCES:
                continue
            first, last, h, g = spans(words)
            if not len(first):
                continue
            seen = np.ones(len(h), bool)
            seen[np.unique(h, return_index=True)[1]] = False
            start, end = _merged(first[seen], last[seen])
            none = np.zeros(len(start), np.int64)
            cols[0] += [h[~seen], none]
            cols[1] += [g[~seen], none]
            rows.append(np.full(len(h) - int(seen.sum()) + len(start), i))
            places += [(first[~seen] << 32) | last[~seen], (start << 32) | end]
            repeats += [np.zeros(len(h) - int(seen.sum()), bool), np.ones(len(start), bool)]
        if rows:
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.concatenate(c)) for c in cols),
                    batch.column("doc_id").take(at),
                    batch.column("mark").take(at),
                    pa.array(np.concatenate(places)),
                    pa.array(np.concatenate(repeats)),
                ],
                names,
            )


def covered(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, places) of every text with sentences to remove.

    ``mark`` is a hash of the text; a place holds the first sentence of a span in its
    upper and the one behind it in its lower 32 bits.
    """
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark")
    )
    found = marked.mapInArrow(
        _emit, "h long, g long, doc_id long, mark long, place long, again boolean"
    )
    # Null ids come first; no id is below the smallest long.
    rank = F.coalesce("doc_id", F.lit(-(2**63)))
    shared = (
        found.where(~F.col("again"))
        .select("h", "g", rank.alias("rank"))
        .groupBy("h", "g")
        .agg(F.min("rank").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("h", "g", "first")
    )
    # Repeats inside a text need no other document: they pass the join under keys of their
    # own (g is never negative), dealt out evenly, so that texts are hashed once for both.
    inside = F.lit(-1).cast("long")
    keyed = found.select(
        F.when(F.col("again"), F.xxhash64("doc_id", "mark", "place")).otherwise(F.col("h")).alias("h"),
        F.when(F.col("again"), inside).otherwise(F.col("g")).alias("g"),
        "doc_id",
        "mark",
        "place",
    )
    met = staged(
        docs.sparkSession,
        keyed.join(shared, ["h", "g"], "left").where(
            (F.col("g") == inside) | F.col("first").isNotNull()
        ),
        "met-spans",
    )
    # Of several texts with the first id the one of smallest hash is first.  Few ids have
    # several texts, so these and then their spans are written: joined by their size, they
    # leave spans that very many texts share where they are.
    several = staged(
        docs.sparkSession,
        met.groupBy(rank.alias("rank"))
        .agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
        .where("least < most")
        .select("rank"),
        "ids-of-several-texts",
    )
    ties = staged(
        docs.sparkSession,
        met.withColumn("rank", rank)
        .where((F.col("g") != inside) & (F.col("rank") == F.col("first")))
        .join(several, "rank", "left_semi")
        .groupBy("h", "g")
        .agg(F.min("mark").alias("first_mark"), F.max("mark").alias("last_mark"))
        .where("first_mark < last_mark")
        .select("h", "g", "first_mark"),
        "tied-spans",
    )
    again = (F.col("g") == inside) | (rank > F.col("first")) | (F.col("mark") > F.col("first_mark"))
    return (
        met.join(ties, ["h", "g"], "left")
        .where(again)
        .groupBy("doc_id", "mark")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )


def _cut(text: str, places) -> tuple[str, int]:
    parts = sentences(text)
    drop = np.zeros(len(parts) + 1, np.int64)
    for place in places:
        drop[place >> 32] += 1
        drop[place & 0xFFFFFFFF] -= 1
    gone = np.cumsum(drop)[:-1] > 0
    return "".join(p for p, out in zip(parts, gone, strict=True) if not out), int(gone.sum())


def removed(docs: DataFrame, name: str) -> DataFrame:
    """The documents without repeated spans, and the number of sentences removed."""
    lists = covered(docs).select(
        F.col("doc_id").alias("list_id"), F.col("mark").alias("list_mark"), "places"
    )

    @F.pandas_udf("text string, removed long")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        rows = [
            (t, 0) if p is None or t is None else _cut(t, p)
            for t, p in zip(texts, places, strict=True)
        ]
        return pd.DataFrame(rows, columns=["text", "removed"])

    rows = docs.select(F.struct("*").alias("doc"))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("list_id")) & (
        F.xxhash64("doc.text") == F.col("list_mark")
    )
    joined = rows.join(lists, same, "left").select(
        "doc", cut(F.col("doc.text"), F.col("places")).alias("cut")
    )
    return joined.select(
        *(
            F.col("cut.text").alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c)
            for c in docs.columns
        ),
        F.col("cut.removed").alias(name),
    )
