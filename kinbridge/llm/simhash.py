"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints: A-Z is lower-cased, words are runs of other than space, tab, newline,
vertical tab, form feed and return, and every run of ``width`` words (the whole text, if
it has fewer) is hashed by XXH64 with seed 42.  A bit is set if more than half of the
hashes, repeats included, have it.

Search: the 64 bits are grouped so that correlated bits share a part.  A part with
threshold t finds the fingerprints that differ from it in at most t of its bits, t = -1
finds none.  If the sum of (t + 1) over the parts is ``distance`` + 1, any two
fingerprints within ``distance`` meet in some part.  Dynamic programming picks the
thresholds, and with them the number of parts, from the counted candidates.  Candidates
are verified on all 64 bits.

Null and empty texts have fingerprint 0, which is linked like any other.  Repeated rows
and exact copies share a fingerprint and are compared once.  An empty table gives no rows.
Null ids are kept as rows; a component's id is the smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm.buckets import UNIT, in_units, whole_units
from kinbridge.llm.common import staged
from kinbridge.llm.components import connected_components

WIDTH = 4
DISTANCE = 4
BITS = 64
#: Numbers of parts that are weighed against each other.
PARTS = (3, 4, 5)
#: Cost of dealing out one probe, in comparisons.
PROBE_COST = 1000
#: Rows of a bucket that one task compares with each other.
BLOCK = 8192
#: Buckets up to this size are compared side by side.
NARROW = 64


def fingerprint(text: str, width: int = WIDTH) -> int:
    """The fingerprint of one whole text as a signed 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: 1 - width or None], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashed = xxhash.xxh64_intdigest
    values = np.fromiter(
        (hashed(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)),
        np.uint64,
        len(starts),
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 65536):
        part = values[at : at + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, name: str, width: int = WIDTH) -> DataFrame:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "", width) for t in texts], dtype="int64")

    return docs.withColumn(name, prints(F.col("text")))


def _bit_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    both, n = np.zeros((BITS, BITS)), 0
    for batch in batches:
        rows = batch["print"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1, bitorder="little").astype(np.float32)
        both += bits.T @ bits
        n += len(bits)
    pairs = np.append(both.ravel(), n)
    yield pd.DataFrame({"at": np.arange(len(pairs)), "n": pairs.astype(np.int64)})


def bit_groups(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width, correlated ones together."""
    share = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tied = np.abs(both / max(1, n) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    left, groups = list(range(BITS)), []
    for width in [BITS // parts + (i < BITS % parts) for i in range(parts)]:
        if len(left) == width:
            groups.append(sorted(left))
            break
        among = tied[np.ix_(left, left)]
        group = [left[int(np.argmax(among.max(axis=1)))]]
        while len(group) < width:
            rest = [b for b in left if b not in group]
            group.append(rest[int(np.argmax(tied[np.ix_(rest, group)].sum(axis=1)))])
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def part_key(bits: list[int]):
    """The bits of a fingerprint in one part, the others 0."""
    return F.col("print").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def thresholds(
    widths: list[int], same: list[float], prints: int, distance: int
) -> tuple[float, list[int]]:
    """The cheapest thresholds with sum of (t + 1) = distance + 1, and their cost.

    ``same`` counts the ordered pairs of fingerprints that agree in a part.  A threshold
    probes all keys within it, each of which is taken to find as many.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, pairs in zip(widths, same, strict=True):
        options: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, distance + 1 - spent):
                probes = sum(comb(width, i) for i in range(t + 1))
                total = cost + probes * (PROBE_COST * max(1, prints) + pairs)
                at = spent + t + 1
                if at not in options or total < options[at][0]:
                    options[at] = (total, [*chosen, t])
        best = options
    return best[distance + 1]


def search_plan(prints: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Parts as (bits, threshold), without those that probe nothing."""
    # At most 64 x 64 + 1 sums come to the driver.
    sums = (
        prints.mapInPandas(_bit_counts, "at int, n long").groupBy("at").agg(F.sum("n")).collect()
    )
    flat = np.zeros(BITS * BITS + 1)
    for at, n in sums:
        flat[at] = n
    both, n = flat[:-1].reshape(BITS, BITS), int(flat[-1])
    tried = {m: bit_groups(both, n, m) for m in PARTS if m <= distance + 1}
    keys = [
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("part"), part_key(bits).alias("key"))
        for m, groups in tried.items()
        for i, bits in enumerate(groups)
    ]
    counted = (
        prints.select(F.inline(F.array(*keys)))
        .groupBy("m", "part", "key")
        .count()
        .groupBy("m", "part")
        .agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs"))
        .collect()
    )
    same = {(r["m"], r["part"]): r["pairs"] for r in counted}
    costs = {
        m: thresholds(
            [len(g) for g in groups],
            [same.get((m, i), 0.0) for i in range(m)],
            n,
            distance,
        )
        for m, groups in tried.items()
    }
    m = min(costs, key=lambda k: costs[k][0])
    return [(g, t) for g, t in zip(tried[m], costs[m][1], strict=True) if t >= 0]


def probes(prints: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, print) for every key within a part's threshold of a fingerprint."""
    out = []
    for i, (bits, t) in enumerate(parts):
        key = part_key(bits)
        for flips in range(t + 1):
            for chosen in combinations(bits, flips):
                mask = _signed(sum(1 << b for b in chosen))
                out.append(
                    F.struct(
                        F.lit(i).alias("part"),
                        key.bitwiseXOR(F.lit(mask)).alias("key"),
                        F.col("print"),
                    )
                )
    return prints.select(F.inline(F.array(*out)))


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges to the smallest member of each group that the pairs connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in parent if root(x) != x]


def _search(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect what is within the distance, at most one per value."""
    left, edges = np.unique(values), []
    while len(left):
        ahead, left = [left[0]], left[1:]
        while ahead and len(left):
            x = ahead.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= distance
            found = left[near]
            if len(found):
                edges += [(int(y), int(x)) for y in found]
                ahead.extend(found)
                left = left[~near]
    return edges


def _verify(distance: int):
    unit = ["part", "key", *UNIT]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_units(batches, unit):
            value = rows["print"].to_numpy()
            new = np.zeros(len(value), bool)
            new[0] = True
            for c in unit:
                x = rows[c].to_numpy()
                new[1:] |= x[1:] != x[:-1]
            group = np.cumsum(new) - 1
            size = np.bincount(group)[group]
            wide = size > NARROW
            edges = []
            for start in np.flatnonzero(new & wide):
                edges += _search(value[start : start + size[start]], distance)
            small, number, pairs = value[~wide], group[~wide], []
            for step in range(1, NARROW):
                same = number[step:] == number[:-step]
                if not same.any():
                    break
                far = np.bitwise_count((small[step:] ^ small[:-step]).view(np.uint64))
                hit = np.flatnonzero(same & (far <= distance))
                pairs += zip(small[hit].tolist(), small[hit + step].tolist(), strict=True)
            edges += _forest(pairs)
            if edges:
                u, v = zip(*edges, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"]
                )

    return near


def near_edges(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (u, v) that connect all fingerprints within the distance.

    Not every close pair becomes an edge, but every close pair is connected by edges.
    """
    parts = search_plan(prints, distance)
    rows = in_units(probes(prints, parts), ["part", "key"], "print", BLOCK)
    return rows.mapInArrow(_verify(distance), "u long, v long")


def with_component(
    spark: SparkSession, docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE
) -> DataFrame:
    """(doc struct, print, component_id) for every row of ``docs``."""
    rows = staged(
        spark,
        with_fingerprint(docs.select("doc_id", "text"), "print", width).select("doc_id", "print"),
        "prints",
    )
    prints = staged(spark, rows.select("print").distinct(), "distinct-prints")
    roots = connected_components(spark, near_edges(prints, distance))
    smallest = rows.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    named = (
        smallest.join(roots, smallest["print"] == roots["node"], "left")
        .select("print", "first_id", F.coalesce("root", "print").alias("root"))
    )
    named = staged(spark, named, "named-prints")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = named.join(ids, "root").select("print", "component_id")
    return rows.join(component, "print").select("doc_id", "print", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of every component, whatever the ids.

    It has the component's smallest id, null only if no row has another.  Of several texts
    with that id the one of smallest hash stays, of several rows with that text the one
    with the smallest other values.
    """
    # Two hashes stand for id and text; a null would leave the hash as it is.
    key = ["mark", "mark_2"]
    own = (F.col("doc_id"), F.col("doc_id").isNull(), F.col("text"), F.col("text").isNull())
    marks = [F.xxhash64(*own).alias(key[0]), F.xxhash64(F.lit(7), *own).alias(key[1])]
    rows = staged(
        spark,
        with_fingerprint(docs.select("doc_id", "text", *marks), "print").select(
            "doc_id", "print", *key
        ),
        "prints",
    )
    prints = staged(spark, rows.select("print").distinct(), "distinct-prints")
    roots = connected_components(spark, near_edges(prints, DISTANCE))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *key)
    kept = (
        rows.groupBy("print")
        .agg(F.min(order).alias("first"))
        .join(roots, F.col("print") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "print").alias("kept_root"))
        .agg(F.min("first").alias("first"))
        .select("kept_root", *(F.col(f"first.{k}").alias(f"kept_{k}") for k in key))
    )
    kept = staged(spark, kept, "kept-rows")
    # A kept pair of hashes belongs to one root, so rows do not multiply.
    given = docs.select(F.struct("*").alias("doc"), *marks)
    same = [F.col(k) == F.col(f"kept_{k}") for k in key]
    return (
        given.join(kept, same)
        .groupBy("kept_root")
        .agg(F.min("doc").alias("doc"))
        .select("doc.*")
    )
