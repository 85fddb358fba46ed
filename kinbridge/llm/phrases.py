"""Phrase collocations by vertical partitioning of a truncated suffix tree.

Text is lower-cased in A-Z, cut into pieces at punctuation and line ends and into words at
blanks and tabs.  Every word begins a suffix, which ends after ``DEPTH`` words, at the end
of the piece, or before a word that occurs less than ``MIN_COUNT`` times in its language or
makes so rare a pair with the one before: no phrase that holds these can be frequent.  Equal
suffixes become one leaf with a total.

The tree of the leaves is never built as a whole.  Its top is cut into word prefixes: a
prefix with more than ``BUDGET`` leaves is replaced by its extensions by one word, until
all fit; prefixes are then packed into groups of at most twice the budget.  Each group's
subtrees are built by themselves, as sorted rows of word numbers, and a node's count is the
total of its leaves.  Nodes above the cut take theirs from the prefix counts.

A candidate is a node of 2 to ``DEPTH`` words.  Its score is the least, over all cuts into
two parts, of floor(1000 * a * n / (l * r)), in exact decimals of 38 digits.  A candidate is
dropped if a longer candidate that holds its words is as frequent; as counts never grow with
the length, it is enough to look one word further.

Frequent words and pairs are counted by hash and known to the tasks by bit tables of fixed
size.  A rare one that meets a set bit makes needless leaves and changes no result, as all
counts of phrases are sums of leaves.

Null texts are empty, null languages are ``und`` and one group with texts so labelled.
Repeated rows and rows without id count each by itself; other columns are not read.  Texts
of any length that fits a task are read whole.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinbridge.llm.buckets import whole_units
from kinbridge.llm.common import small_side, staged

DEPTH = 5
MIN_COUNT = 100
TOP = 2000
#: Leaves a prefix may hold before it is extended by a word.
BUDGET = 1_000_000
#: Words whose suffixes are named and merged together in a task.
SLICE_WORDS = 250_000
#: Prefixes that are packed into groups by one window.
PACKED = 20_000
TABLE_BITS = 1 << 26
#: Hashes that are counted are cut to so many bits, which a shuffle stores in fewer bytes.
KEY_BITS = 40

UNKNOWN = "und"
BREAK = b""
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Lower case in A-Z; every end of a piece becomes a line end.
_FOLD = bytes.maketrans(_UPPER + b".,;:!?\x0b\x0c\x0d", _UPPER.lower() + b"\n" * 9)

COUNTS = "lang string, phrase string, n long"


def _language() -> Column:
    return F.coalesce("lang", F.lit(UNKNOWN))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(_language().alias("lang"), F.col("text").cast("string").alias("text"))


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words of every text, with BREAK behind every piece."""
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole = text.as_buffer().to_pybytes() if text.is_valid else b""
            words: list[bytes] = []
            for piece in whole.translate(_FOLD).split(b"\n"):
                words += piece.split()
                words.append(BREAK)
            yield lang, words


def _same(lang: str, rows: int) -> pa.Array:
    return pa.array([lang]).take(pa.array(np.zeros(rows, np.int32)))


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42)


def _short(keys: np.ndarray) -> pa.Array:
    return pa.array((keys & np.uint64((1 << KEY_BITS) - 1)).view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, n): occurrences by the hash of language and word, and, without a key,
    of all words of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def rows(lang: str, counts: Counter) -> pa.RecordBatch:
            del counts[BREAK]
            seed = _seed(lang)
            keys = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in counts), np.uint64)
            langs = pa.array([lang, None]).take(pa.array(np.sign(np.arange(len(keys) + 1))))
            return pa.RecordBatch.from_arrays(
                [
                    langs,
                    pa.concat_arrays([pa.array([None], pa.int64()), _short(keys)]),
                    pa.array([counts.total(), *counts.values()], pa.int64()),
                ],
                names=["lang", "key", "n"],
            )

        for lang, words in _worded(batches):
            held[lang].update(words)
            if len(held[lang]) >= SLICE_WORDS:
                yield rows(lang, held.pop(lang))
        for lang, counts in held.items():
            yield rows(lang, counts)

    found = _texts(docs).mapInArrow(count, "lang string, key long, n long")
    return found.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def frequent_bits(counts: DataFrame, least: int) -> bytes:
    """A bit table of fixed size with the keys that occur at least ``least`` times."""
    place = F.pmod("key", F.lit(TABLE_BITS))
    blocks = (
        counts.where(F.col("key").isNotNull() & (F.col("n") >= least))
        .select(place.alias("place"))
        .groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("block"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bits"))
    )
    held = bytearray(TABLE_BITS // 8)
    for row in blocks.toLocalIterator():
        at = (row["block"] - 1) * len(row["bits"])
        held[at : at + len(row["bits"])] = row["bits"]
    return bytes(held)


class _Numbers:
    """Numbers of frequent words of one language in one task; 0 stands for all others."""

    def __init__(self, lang: str, bits: bytes):
        self.seed, self.bits = _seed(lang), bits
        self.known: dict[bytes, int] = {BREAK: 0}
        self.words: list[bytes] = [BREAK]
        self.hashes = array("Q", [0])

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        for word in set(words).difference(known):
            key = xxhash.xxh64_intdigest(word, self.seed)
            place = key % TABLE_BITS
            if self.bits[place >> 3] >> (place & 7) & 1:
                known[word] = len(self.words)
                self.words.append(word)
                self.hashes.append(key)
            else:
                known[word] = 0
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


def _next(ids: np.ndarray) -> np.ndarray:
    return np.concatenate([ids[1:], np.zeros(min(1, len(ids)), ids.dtype)])


def pair_keys(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different pairs of frequent words, and the pair at each place or -1."""
    after = _next(ids)
    size = len(hashes)
    pairs = np.where((ids > 0) & (after > 0), ids.astype(np.int64) * size + after, -1)
    codes, found = pd.factorize(pairs)
    if -1 in found:
        none = np.flatnonzero(found == -1)[0]
        codes = np.where(codes == none, -1, codes - (codes > none))
        found = np.delete(found, none)
    first, second = hashes[found // size], hashes[found % size]
    keys = (first ^ (second * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(31)), codes


def _sliced(
    batches: Iterator[pa.RecordBatch], bits: bytes
) -> Iterator[tuple[str, np.ndarray, _Numbers]]:
    """Numbered words of one language, some texts at a time."""
    numbers: dict[str, _Numbers] = {}
    held: dict[str, list[np.ndarray]] = {}
    n_held = 0
    for lang, words in _worded(batches):
        if lang not in numbers:
            numbers[lang] = _Numbers(lang, bits)
        held.setdefault(lang, []).append(numbers[lang].of(words))
        n_held += len(words)
        if n_held >= SLICE_WORDS:
            for key in list(held):
                yield key, np.concatenate(held.pop(key)), numbers[key]
            n_held = 0
    for key in list(held):
        yield key, np.concatenate(held.pop(key)), numbers[key]


def pair_counts(spark: SparkSession, docs: DataFrame, bits: bytes) -> DataFrame:
    """(key, n): occurrences of pairs of frequent words, by hash."""
    shared = spark.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, numbers in _sliced(batches, shared.value):
            keys, at = pair_keys(ids, np.frombuffer(numbers.hashes, np.uint64).copy())
            n = np.bincount(at[at >= 0], minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [_short(keys), pa.array(n.astype(np.int64))], names=["key", "n"]
            )

    found = _texts(docs).mapInArrow(count, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def _named(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 1 for the pairs (high, low); 0 where ``high`` is 0."""
    codes, found = pd.factorize(np.where(high > 0, high * (low.max(initial=0) + 1) + low, 0))
    zero = np.flatnonzero(found == 0)
    names = codes + 1
    if len(zero):
        names[codes == zero[0]] = 0
    return names, len(found) + 1


def merged_suffixes(
    ids: np.ndarray, linked: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and number of each different suffix of up to DEPTH (five) words.

    ``linked`` tells whether a place and the next one hold a frequent pair.  Pairs of
    words get names, then pairs of pairs, then those with the fifth word.
    """
    ids = ids.astype(np.int64)
    words, goes_on = [ids], np.ones(len(ids), bool)
    far, link = ids, linked
    for _ in range(DEPTH - 1):
        goes_on = goes_on & link
        far, link = _next(far), _next(link)
        words.append(np.where(goes_on, far, 0))
    two, _ = _named(ids, words[1])
    four, _ = _named(two, np.where(words[2] > 0, _next(_next(two)), 0))
    five, size = _named(four, words[4])
    length = sum((w > 0).astype(np.int8) for w in words)
    counts = np.bincount(five, minlength=size)
    first = np.zeros(size, np.int64)
    first[five[::-1]] = np.arange(len(five))[::-1]
    used = np.flatnonzero(counts)
    used = used[used > 0]
    return first[used], length[first[used]], counts[used]


def suffix_counts(
    spark: SparkSession, docs: DataFrame, word_bits: bytes, pair_bits: bytes
) -> DataFrame:
    """(lang, phrase, n): the leaves, each once."""
    shared = spark.sparkContext.broadcast((word_bits, pair_bits))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pairs = shared.value
        table = np.frombuffer(pairs, np.uint8)
        for lang, ids, numbers in _sliced(batches, known):
            keys, at = pair_keys(ids, np.frombuffer(numbers.hashes, np.uint64).copy())
            place = keys % np.uint64(TABLE_BITS)
            frequent = table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            linked = np.append(frequent > 0, False)[at]  # -1 is the last one
            starts, lengths, counts = merged_suffixes(ids, linked)
            word = numbers.words
            phrases = [
                b" ".join([word[i] for i in ids[s : s + k].tolist()])
                for s, k in zip(starts.tolist(), lengths.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    _same(lang, len(phrases)),
                    pa.array(phrases, pa.binary()).cast(pa.string()),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["lang", "phrase", "n"],
            )

    return _texts(docs).mapInArrow(cut, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _first_words(words: int) -> Column:
    return F.substring_index("phrase", " ", words)


#: Number of words of a phrase.
_SIZE = "(length(phrase) - length(replace(phrase, ' ', '')) + 1)"


def cut_prefixes(
    spark: SparkSession, leaves: DataFrame, budget: int = BUDGET
) -> tuple[DataFrame, DataFrame]:
    """Leaves with the prefix and depth of their subtree, and the nodes above the cut.

    The list of extended prefixes is short: each holds more than ``budget`` leaves.
    """
    open_leaves = leaves.withColumns({"prefix": _first_words(1), "depth": F.lit(1)})
    above = None
    for depth in range(1, DEPTH):
        weight = open_leaves.where(F.col("depth") == depth).groupBy("lang", "prefix").agg(
            F.count("*").alias("leaves"), F.sum("n").alias("n")
        )
        full = staged(spark, weight.where(F.col("leaves") > budget), "phrase-prefixes")
        n_full = full.count()
        if not n_full:
            break
        nodes = full.select("lang", F.col("prefix").alias("phrase"), "n")
        above = nodes if above is None else above.unionByName(nodes)
        extended = full.select("lang", "prefix", F.lit(depth + 1).alias("next"))
        longer = F.col("next").isNotNull()
        open_leaves = (
            open_leaves.join(small_side(extended, n_full), ["lang", "prefix"], "left")
            # A leaf that ends at an extended prefix is counted there.
            .where(~longer | (F.expr(_SIZE) > F.col("depth")))
            .withColumns(
                {
                    "prefix": F.when(longer, _first_words(depth + 1)).otherwise(F.col("prefix")),
                    "depth": F.when(longer, F.col("next")).otherwise(F.col("depth")),
                }
            )
            .drop("next")
        )
    return open_leaves, spark.createDataFrame([], COUNTS) if above is None else above


def packed(spark: SparkSession, cut: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(lang, prefix, unit): prefixes in groups of at most twice the budget.

    Prefixes are dealt by hash to bins of some thousands and packed there in order, so
    no task sees all of them.
    """
    weights = staged(
        spark,
        cut.groupBy("lang", "prefix").agg(F.count("*").alias("leaves")),
        "phrase-weights",
    )
    bins = max(1, math.ceil(weights.count() / PACKED))
    binned = weights.withColumn("bin", F.pmod(F.xxhash64("lang", "prefix", F.lit(3)), F.lit(bins)))
    before = Window.partitionBy("bin").orderBy("lang", "prefix")
    filled = F.sum("leaves").over(before) - F.col("leaves")
    unit = F.concat_ws("-", "bin", F.floor(filled / budget).cast("long"))
    return binned.select("lang", "prefix", unit.alias("unit"))


def subtree_nodes(
    words: pa.ListArray, totals: np.ndarray, tops: np.ndarray, least: int
) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """The nodes of at least ``least`` occurrences of the subtrees of some leaves.

    Yields, for every depth, a leaf below each node, the depth and the node's total.
    ``tops`` is the depth at which each leaf's subtree begins.
    """
    numbers = pc.dictionary_encode(words.flatten()).indices.to_numpy() + 1
    offsets = words.offsets.to_numpy()
    lengths, start = np.diff(offsets), offsets[0]
    table = np.zeros((len(lengths), DEPTH), np.int64)
    for depth in range(DEPTH):
        there = lengths > depth
        table[there, depth] = numbers[offsets[:-1][there] - start + depth]
    order = np.lexsort(table.T[::-1])
    table, totals, tops = table[order], totals[order], tops[order]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for depth in range(1, DEPTH + 1):
        new[1:] |= table[1:, depth - 1] != table[:-1, depth - 1]
        begin = np.flatnonzero(new)
        if not len(begin):
            return
        sums = np.add.reduceat(totals, begin)
        real = (table[begin, depth - 1] > 0) & (tops[begin] <= depth) & (sums >= least)
        yield order[begin[real]], depth, sums[real]


def tree_counts(
    spark: SparkSession, cut: DataFrame, groups: DataFrame, least: int = MIN_COUNT
) -> DataFrame:
    """(lang, phrase, n): the nodes of all subtrees, group by group."""
    unit = ["unit", "lang"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches, unit):
            # A group's languages are trees of their own.
            for lang in pc.unique(table.column("lang")).to_pylist():
                mine = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
                for key in pc.unique(mine.column("unit")).to_pylist():
                    leaves = mine.filter(pc.equal(mine.column("unit"), key)).combine_chunks()
                    yield from nodes(lang, leaves)

    def nodes(lang: str, leaves: pa.Table) -> Iterator[pa.RecordBatch]:
        words = pc.split_pattern(leaves.column("phrase"), " ").combine_chunks()
        for at, depth, sums in subtree_nodes(
            words, leaves.column("n").to_numpy(), leaves.column("depth").to_numpy(), least
        ):
            if not len(at):
                continue
            parts = pc.list_slice(words.take(pa.array(at)), 0, depth)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]).take(pa.array(np.zeros(len(at), np.int32))),
                    pc.binary_join(parts, " "),
                    pa.array(sums, pa.int64()),
                ],
                names=["lang", "phrase", "n"],
            )

    n_groups = groups.count()
    rows = cut.join(small_side(groups, n_groups), ["lang", "prefix"]).select(
        "unit", "lang", "phrase", "n", "depth"
    )
    return rows.repartition("unit").sortWithinPartitions(*unit).mapInArrow(build, COUNTS)


def frequent_phrases(
    spark: SparkSession,
    docs: DataFrame,
    least: int = MIN_COUNT,
    budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases up to DEPTH words, and (lang, words) of all texts."""
    words = staged(spark, word_counts(docs), "phrase-words")
    languages = words.where("key IS NULL").select("lang", F.col("n").alias("words"))
    word_bits = frequent_bits(words, least)
    pair_bits = frequent_bits(pair_counts(spark, docs, word_bits), least)
    leaves = staged(spark, suffix_counts(spark, docs, word_bits, pair_bits), "phrase-leaves")
    cut, above = cut_prefixes(spark, leaves, budget)
    below = tree_counts(spark, cut, packed(spark, cut, budget), least)
    found = above.where(F.col("n") >= least).unionByName(below)
    return staged(spark, found, "phrase-nodes"), languages


def scored(nodes: DataFrame, languages: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): candidates at their lowest-scoring cut."""
    candidates = nodes.where(F.contains("phrase", F.lit(" "))).select(
        "lang", "phrase", F.col("n").alias("a")
    )
    cuts = candidates.withColumn("k", F.expr(f"explode(sequence(1, {_SIZE} - 1))")).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr(f"substring_index(phrase, ' ', k - {_SIZE})").alias("right"),
    )
    left = nodes.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = nodes.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    above = (F.lit(1000).cast("decimal(4,0)") * big("a")).cast("decimal(23,0)")
    score = F.expr("above div below")
    met = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(small_side(languages), "lang")
        .withColumns(
            {
                "above": (above * F.col("words").cast("decimal(15,0)")).cast("decimal(38,0)"),
                "below": (big("l") * big("r")).cast("decimal(38,0)"),
            }
        )
        .withColumn("score", score.cast("long"))
    )
    best = F.min(F.struct("score", "k", "l", "r"))
    return (
        met.groupBy("lang", "phrase", "a", F.col("words").alias("n"))
        .agg(best.alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    )


def covered(nodes: DataFrame) -> DataFrame:
    """(lang, phrase) of candidates inside an equally frequent one of one word more."""
    longer = nodes.where(F.expr(_SIZE) > 2).select("lang", "n", "phrase")
    inside = longer.select(
        "lang",
        "n",
        F.explode(
            F.array(
                F.expr(f"substring_index(phrase, ' ', {_SIZE} - 1)"),
                F.expr(f"substring_index(phrase, ' ', 1 - {_SIZE})"),
            )
        ).alias("phrase"),
    )
    # The most frequent longer one decides.
    most = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    return nodes.join(most, ["lang", "phrase"]).where("longest >= n").select("lang", "phrase")


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    least: int = MIN_COUNT,
    top: int = TOP,
    budget: int = BUDGET,
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    nodes, languages = frequent_phrases(spark, docs, least, budget)
    kept = scored(nodes, languages).join(covered(nodes), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        kept.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
    )
