"""Exact top-k by integer inner product with norm-bucketed retrieval.

Components are floor(1024 x).  Candidates are sorted by length into buckets of bounded
size.  Queries, in blocks, first meet the bucket of the longest vectors, which gives
every query a lower bound of its k-th score.  In each other bucket a query's bound and
the longest length there give a local cosine threshold.  Above 1 the bucket is skipped.
A high threshold prunes by coordinates: a candidate must lie, in each of the query's
largest coordinates, within the angle that the threshold allows.  A low one prunes by
length alone: candidates shorter than bound / query length are left out.  What stays is
verified by exact integer products.

Which buckets a block of queries may need is found first, from their lengths and bounds
alone; only these pairs get their vectors.

Vectors that are null, empty or hold null or non-finite components take no part.  Only
vectors of one length are compared.  Rows are told apart by a number, not by their id:
rows that share an id are candidates and queries of their own, and rows without id are
candidates.  Ties go to the smaller id, a missing one last.  A query returns all
candidates if there are fewer than k.  Scores beyond 64 bits are held at the limits of a
long.  Other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinbridge.llm.common import BROADCAST_ROWS, small_side, staged
from kinbridge.llm.vectors import usable

K = 10
SCALE = 1024
QUERY_MODULUS = 100
BUCKET_ROWS = 4096
QUERY_ROWS = 512
#: From this local cosine threshold on, coordinates prune.
COORDINATE_COSINE = 0.6
FOCUS = 4


def _exact(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where it is exact."""
    if not len(q) or not len(p):
        return np.zeros((len(q), len(p)), np.int64)
    bound = float(np.abs(q).max()) * float(np.abs(p).max()) * q.shape[1]
    if bound < 2**53:
        return (q @ p.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in r] for r in x], dtype=object)
    return np.clip(whole(q) @ whole(p).T, -(2**63), 2**63 - 1).astype(np.int64)


class Bucket:
    """Candidates of nearly equal length, longest first."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, known: np.ndarray, x: np.ndarray):
        self.length = np.linalg.norm(x, axis=1)
        order = np.argsort(-self.length, kind="stable")
        self.rows, self.ids, self.known = rows[order], ids[order], known[order]
        self.x, self.length = x[order], self.length[order]
        self.unit = self.x / np.maximum(self.length, 1e-300)[:, None]

    def candidates(self, q: np.ndarray, bound: float) -> np.ndarray | slice:
        """Places of all candidates whose product with q may reach the bound."""
        if not np.isfinite(bound) or bound <= 0:
            return slice(None)  # no length and no angle is excluded
        size = float(np.linalg.norm(q))
        slack = 1 - 1e-9
        if size == 0 or size * self.length[0] < bound * slack:
            return slice(0, 0)
        local = bound * slack / (size * self.length[0])
        stop = int(np.searchsorted(-self.length, -(bound * slack / size), side="right"))
        if local < COORDINATE_COSINE:
            return slice(0, stop)
        turn = np.arccos(min(1.0, local)) + 1e-7
        focus = np.argsort(-np.abs(q))[: min(FOCUS, len(q))]
        angle = np.arccos(np.clip(q[focus] / size, -1, 1))
        low = np.cos(np.minimum(angle + turn, np.pi)) - 1e-9
        high = np.cos(np.maximum(angle - turn, 0)) + 1e-9
        near = self.unit[:stop, focus]
        return np.flatnonzero(((near >= low) & (near <= high)).all(axis=1))


def _best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id and missing ids last."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], ~known[some], -scores[some]))][:k]


class _Found:
    """The best candidates of a block's queries in one bucket."""

    def __init__(self, bucket: Bucket, k: int):
        self.bucket, self.k = bucket, k
        self.queries, self.ids, self.known, self.scores = [], [], [], []

    def add(self, scores: np.ndarray, places: np.ndarray | slice, query: int, bound: float) -> None:
        ids, known = self.bucket.ids[places], self.bucket.known[places]
        other = (self.bucket.rows[places] != query) & (scores >= bound)
        scores, ids, known = scores[other], ids[other], known[other]
        best = _best(scores, ids, known, self.k)
        self.queries.append(np.full(len(best), query, np.int64))
        for all_of, some in ((self.ids, ids), (self.known, known), (self.scores, scores)):
            all_of.append(some[best])

    def batch(self) -> pa.RecordBatch:
        joined = lambda xs, kind: np.concatenate([*xs, np.empty(0, kind)])
        unknown = ~joined(self.known, bool).astype(bool)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(joined(self.queries, np.int64), pa.int64()),
                pa.array(joined(self.ids, np.int64), pa.int64(), mask=unknown),
                pa.array(joined(self.scores, np.int64), pa.int64()),
            ],
            ["query", "vec_id", "score"],
        )


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                as_rows = lambda b: np.frombuffer(b, np.float64).reshape(-1, dim)
                numbers = lambda b: np.frombuffer(b, np.int64)
                q, queries = as_rows(row["q"]), numbers(row["q_rows"])
                bounds = np.frombuffer(row["bounds"], np.float64)
                known = np.frombuffer(row["p_known"], np.uint8).astype(bool)
                bucket = Bucket(numbers(row["p_rows"]), numbers(row["p_ids"]), known, as_rows(row["p"]))
                found, plain = _Found(bucket, k), []
                for n in range(len(q)):
                    places = bucket.candidates(q[n], bounds[n])
                    if isinstance(places, slice) and places.stop != 0:
                        plain.append((n, places.stop or len(bucket.ids)))
                        continue
                    products = _exact(q[n : n + 1], bucket.x[places])[0]
                    found.add(products, places, queries[n], bounds[n])
                if plain:
                    # Length pruning leaves prefixes, verified together.
                    some, stops = map(list, zip(*plain, strict=True))
                    products = _exact(q[some], bucket.x[: max(stops)])
                    for scores, n, stop in zip(products, some, stops, strict=True):
                        found.add(scores[:stop], slice(0, stop), queries[n], bounds[n])
                yield found.batch()

    return run


def _packed(rows: DataFrame, out: str, most: int) -> DataFrame:
    """Rows (row, vec_id, dim, x, norm) of each task packed, in order, into blocks of
    ``most`` rows with the length of the longest."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(dim: int, held: list[tuple]) -> pa.RecordBatch:
            numbers, ids, xs = zip(*held)
            known = np.array([i is not None for i in ids], np.uint8)
            vectors = np.concatenate(xs)
            longest = np.linalg.norm(vectors.reshape(-1, dim), axis=1).max()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dim], pa.int32()),
                    pa.array([float(longest)], pa.float64()),
                    pa.array([np.array(numbers, np.int64).tobytes()], pa.binary()),
                    pa.array([np.array([i or 0 for i in ids], np.int64).tobytes()], pa.binary()),
                    pa.array([known.tobytes()], pa.binary()),
                    pa.array([vectors.tobytes()], pa.binary()),
                ],
                ["dim", "longest", f"{out}_rows", f"{out}_ids", f"{out}_known", out],
            )

        dim, held = 0, []
        for batch in batches:
            dims = batch.column("dim").to_pylist()
            numbers = batch.column("row").to_pylist()
            ids = batch.column("vec_id").to_pylist()
            flat = batch.column("x").flatten().to_numpy()
            ends = np.cumsum(dims)
            for d, number, i, end in zip(dims, numbers, ids, ends.tolist(), strict=True):
                if held and (d != dim or len(held) == most):
                    yield block(dim, held)
                    held = []
                dim = d
                held.append((number, i, flat[end - d : end]))
        if held:
            yield block(dim, held)

    return rows.select("dim", "row", "vec_id", "x").mapInArrow(
        pack,
        f"dim int, longest double, {out}_rows binary, {out}_ids binary, {out}_known binary, {out} binary",
    )


def _spread(df: DataFrame, rows: int, each: int, *keys) -> DataFrame:
    """Sorted by keys over tasks of about ``each`` rows."""
    return df.repartitionByRange(max(1, -(-rows // each)), *keys).sortWithinPartitions(*keys)


def search(
    spark: SparkSession, rows: DataFrame, modulus: int = QUERY_MODULUS, k: int = K
) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id ``modulus`` divides."""
    whole = staged(
        spark,
        usable(
            rows.select("vec_id", F.col("embedding").cast("array<double>").alias("e")), "e"
        )
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.size("e").alias("dim"),
            # Floats, as floor() of a column would stop at the range of a long.
            F.transform("e", lambda v: F.floor(v * SCALE).cast("double")).alias("x"),
        )
        .withColumn(
            "norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
        ),
        "vectors",
    )
    n = whole.count()
    asked = whole.where(F.col("vec_id") % modulus == 0)
    n_asked = asked.count()
    buckets = staged(
        spark,
        _packed(
            _spread(whole, n, 4 * BUCKET_ROWS, "dim", F.desc("norm"), "row"), "p", BUCKET_ROWS
        ).withColumn("bucket", F.monotonically_increasing_id()),
        "buckets",
    )
    asking = staged(
        spark,
        _packed(
            _spread(asked, n_asked, 4 * QUERY_ROWS, "dim", F.desc("norm"), "row"), "q", QUERY_ROWS
        ).withColumn("block", F.monotonically_increasing_id()),
        "queries",
    )
    # Ranges put the longest vectors of a length first, so its first bucket has them.
    lengths = buckets.select("bucket", "dim", "longest")
    first = lengths.groupBy("dim").agg(F.min("bucket").alias("bucket"))
    blocks = asking.select("block", "dim")
    n_blocks = blocks.count()

    def meet(pairs: DataFrame, bounded: DataFrame) -> DataFrame:
        """Scores of the pairs (block, bucket), which get their vectors here."""
        met = (
            pairs.select("block", "bucket")
            .join(buckets.select("bucket", "p_rows", "p_ids", "p_known", "p"), "bucket")
            .join(bounded.select("block", "dim", "q_rows", "q", "bounds"), "block")
        )
        return met.repartition(F.col("block"), F.col("bucket")).mapInArrow(
            _search(k), "query long, vec_id long, score long"
        )

    seeds = blocks.join(small_side(first), "dim")
    found = staged(spark, meet(seeds, _without_bounds(asking)), "first-scores")
    kth = (
        found.groupBy("query")
        .agg(F.min("score").alias("kth"), F.count("*").alias("n"))
        .where(F.col("n") >= k)
        .select("query", "kth")
    )
    bounded = staged(spark, _with_bounds(asking, kth, asked), "bounds")
    rest = lengths.join(first, ["dim", "bucket"], "left_anti")
    # Salts keep a shuffle of many blocks from meeting in one task per length.
    salts = max(1, n_blocks // BROADCAST_ROWS)
    salted = bounded.select("block", "dim", "least").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    pairs = (
        rest.withColumn("salt", F.pmod("bucket", F.lit(salts)).cast("int"))
        .join(small_side(salted, n_blocks * salts), ["dim", "salt"])
        .where(F.col("longest") >= F.col("least") * (1 - 1e-9))
    )
    every = found.union(meet(pairs, bounded))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(
        asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query"
    ).select("query_id", "rank", "vec_id", "score")


def _without_bounds(asking: DataFrame) -> DataFrame:
    @F.pandas_udf("binary")
    def none(rows: pd.Series) -> pd.Series:
        return rows.map(lambda b: np.full(len(b) // 8, -np.inf).tobytes())

    return asking.withColumn("bounds", none("q_rows"))


def _with_bounds(asking: DataFrame, kth: DataFrame, asked: DataFrame) -> DataFrame:
    """Query blocks with the lower bound of every query's k-th score, and the least length
    of a candidate that any of them needs."""

    @F.pandas_udf("array<long>")
    def listed(rows: pd.Series) -> pd.Series:
        return rows.map(lambda b: np.frombuffer(b, np.int64))

    @F.pandas_udf("binary")
    def packed(bounds: pd.Series) -> pd.Series:
        return bounds.map(
            lambda rows: np.array(
                [-np.inf if r["kth"] is None else r["kth"] for r in rows], np.float64
            ).tobytes()
        )

    norms = asked.select(F.col("row").alias("query"), "norm")
    needed = F.when(F.col("kth") > 0, F.col("kth") / F.col("norm")).otherwise(0.0)
    bounds = (
        asking.select("block", F.posexplode(listed("q_rows")).alias("at", "query"))
        .join(norms, "query")
        .join(kth, "query", "left")
        .groupBy("block")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "kth"))).alias("rows"),
            F.min(needed).alias("least"),
        )
        .select("block", packed("rows").alias("bounds"), "least")
    )
    return asking.join(bounds, "block")
