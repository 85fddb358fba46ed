"""Embedding near-duplicates by randomly rotated binary codes.

Vectors of one label and length are compared by cosine.  Exact copies become one class
first.  A label with many classes is cut into cells around centres fitted on a bounded
sample; every class lives in the nearest cell.  Between its cell and any other lies the
plane of points equally near to both centres: a class that is further from it than the
threshold's angle links with nothing that lives behind it.  Of any two cells one receives
the classes of the other that are not that far, so every pair that may reach the threshold
is compared, and in one cell only.  Vectors without structure are near to all planes: then
all pairs of a label are compared by their codes, and every class is sent to about half of
the cells.

In a cell a vector is the unit residual from the centre, rotated at random.  Its code is
the signs of the rotated components, stored with the correction factor <code, residual>.
For a pair, the inner product of one's code with the other's rotated residual, whose
components are rounded at random to 4 bits and multiplied by population counts, divided
by the factor, estimates the inner product without bias; its error has a bound of
``EPSILON`` deviations.  Only pairs whose upper bound reaches the threshold are
recomputed in double precision, and only those that reach it exactly are linked.

Links are counted and pairs are never listed: a cell returns, per class, how many rows
it links with there, and edges that connect them.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors
without label, link with nothing; they are returned with 0 links and are their own
component.  Copies link with each other.  Repeated rows count as rows.  Null ids are
kept; a component's id is its smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm.buckets import UNIT, whole_units
from kinbridge.llm.common import first_by_hash, small_side, staged
from kinbridge.llm.components import connected_components
from kinbridge.llm.vectors import usable

COSINE = 0.93
#: Classes drawn to fit the cells.
SAMPLE_ROWS = 32_768
#: Classes that a cell is meant to hold, and the sample rows a centre needs.
CELL_ROWS = 512
ROWS_PER_CENTRE = 8
EPSILON = 3.0
PLANES = 4
BLOCK = 2048
#: Rows of which the margins to all cells are held at once.
MARGIN_ROWS = 256
#: For rounding, as cosines.
SLACK = 1e-7
SEED = 11

_UNIT_COLUMNS = ["label", "dim", "cell", *UNIT]


def _unit_rows(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    """Centres of spherical k-means after a few rounds; x has unit rows in hashed order."""
    centres = x[:: max(1, len(x) // k)][:k].copy()
    for _ in range(6):
        near = np.argmax(x @ centres.T, axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = x[near == c].sum(axis=0)
        centres = _unit_rows(centres)
    return centres


def fit_cells(classes: DataFrame, n: int, sample_rows: int) -> dict[tuple[int, int], np.ndarray]:
    """Centres per (label, length) that has more classes than a cell should hold."""
    rows = classes.select("label", "dim", "rep", "vector")
    sample = first_by_hash(rows, "rep", sample_rows, n, SEED).toPandas()
    scale = n / max(1, len(sample))
    found = {}
    for (label, dim), rows in sample.groupby(["label", "dim"]):
        k = min(round(len(rows) * scale / CELL_ROWS), len(rows) // ROWS_PER_CENTRE)
        if k > 1:
            found[int(label), int(dim)] = _centres(_unit_rows(np.stack(rows["vector"])), k)
    return found


def cells_to_visit(unit: np.ndarray, centres: np.ndarray, cosine: float) -> list[list[int]]:
    """Per unit row its home cell and, behind it, the cells that it visits."""
    # An angle of 90 degrees and more reaches behind every plane.
    reach = np.sqrt(1 - min(cosine, 1.0) ** 2) if cosine > 0 else np.inf
    norm2 = (centres * centres).sum(axis=1)
    number = np.arange(len(centres))
    out = []
    for at in range(0, len(unit), MARGIN_ROWS):
        near = unit[at : at + MARGIN_ROWS] @ centres.T
        home = np.argmax(near, axis=1)
        ahead = near[np.arange(len(near)), home][:, None] - near
        between = norm2[home][:, None] + norm2[None, :] - 2 * centres[home] @ centres.T
        # Margins are multiplied by the distance of the centres, which may be 0.
        within = ahead <= reach * np.sqrt(np.maximum(between, SLACK**2)) + SLACK
        # Of two cells, the lower receives if the sum of their numbers is odd, else the other.
        odd = (home[:, None] + number[None, :]) % 2 == 1
        receives = np.where(odd, number[None, :] < home[:, None], number[None, :] > home[:, None])
        for h, goes in zip(home.tolist(), within & receives, strict=True):
            out.append([h, *np.flatnonzero(goes).tolist()])
    return out


def _with_cells(centres, cosine: float):
    """Adds the cells of a class: its home and those that it visits."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            cells: list[list[int]] = [[0]] * len(labels)
            for label, dim in {*zip(labels.tolist(), dims.tolist(), strict=True)}:
                c = centres.value.get((label, dim))
                if c is None:
                    continue
                at = np.flatnonzero((labels == label) & (dims == dim))
                x = batch.column("vector").take(pa.array(at)).flatten().to_numpy()
                unit = _unit_rows(x.reshape(len(at), dim))
                for i, found in zip(at, cells_to_visit(unit, c, cosine), strict=True):
                    cells[i] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))],
                [*batch.schema.names, "cells"],
            )

    return assign


def in_cell_units(rows: DataFrame) -> DataFrame:
    """``rows`` with columns own_block, block_a and block_b, dealt out and sorted by unit.

    Those that live in a cell are cut into blocks, and so are those that visit it.  Every
    two blocks of the first kind, and a block of each kind, meet in one unit; visitors do
    not meet each other.  The first block of visitors shares the units in which a block of
    the others meets itself.
    """
    keys = ["label", "dim", "cell"]
    counts = rows.groupBy(*keys).agg(
        F.count_if("lives").alias("living"), F.count_if(~F.col("lives")).alias("visiting")
    )
    large = counts.where((F.col("living") > BLOCK) | (F.col("visiting") > BLOCK)).select(
        *(F.col(k).alias(f"large_{k}") for k in keys),
        *(
            F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int").alias(f"{c}_blocks")
            for c in ("living", "visiting")
        ),
    )
    same = [F.col(k) == F.col(f"large_{k}") for k in keys]
    living = F.coalesce("living_blocks", F.lit(1))
    visiting = F.coalesce("visiting_blocks", F.lit(1))
    own, other = F.col("own_block"), F.col("other")
    # Numbers from ``living`` on stand for the second and later blocks of visitors.
    others = F.when(F.col("lives"), living + visiting - 1).otherwise(living)
    visitors = F.when(own == 0, other).otherwise(living + own - 1)
    cut = (
        rows.join(small_side(large), same, "left")
        .withColumn(
            "own_block",
            F.pmod(
                F.xxhash64("rep", F.lit(7)), F.when(F.col("lives"), living).otherwise(visiting)
            ).cast("int"),
        )
        .withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
        .withColumn("block_a", F.when(F.col("lives"), F.least(own, other)).otherwise(other))
        .withColumn("block_b", F.when(F.col("lives"), F.greatest(own, other)).otherwise(visitors))
        .select(*rows.columns, "own_block", *UNIT)
    )
    unit = [*keys, *UNIT]
    return cut.repartition(*unit).sortWithinPartitions(*unit)


def rotation(dim: int) -> np.ndarray:
    """A random rotation, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """Codes and correction factors of vectors around a centre."""

    def __init__(self, unit: np.ndarray, centre: np.ndarray):
        dim = unit.shape[1]
        rest = unit - centre
        self.length = np.linalg.norm(rest, axis=1)
        rest = rest / np.maximum(self.length, 1e-300)[:, None]
        turned = rest @ rotation(dim).T
        signs = turned > 0
        self.code = _packed(signs)
        self.ones = signs.sum(axis=1)
        self.factor = np.maximum(np.abs(turned).sum(axis=1) / np.sqrt(dim), 1e-9)
        # Components rounded at random to PLANES bits, one packed row per bit.
        self.low = turned.min(axis=1)
        top = (1 << PLANES) - 1
        self.step = np.maximum((turned.max(axis=1) - self.low) / top, 1e-300)
        noise = np.random.default_rng(SEED).random(dim)
        levels = np.floor((turned - self.low[:, None]) / self.step[:, None] + noise)
        levels = np.clip(levels, 0, top).astype(np.int64)
        self.planes = [_packed((levels >> p) & 1 == 1) for p in range(PLANES)]
        self.levels = levels.sum(axis=1)
        self.to_centre = unit @ centre
        self.dim = dim

    def upper_cosine(self, a: np.ndarray, b: np.ndarray, centre_norm2: float) -> np.ndarray:
        """Upper bound of the cosine of every row of ``a`` with every row of ``b``."""
        dot = np.zeros((len(a), len(b)))
        for p, plane in enumerate(self.planes):
            for w in range(self.code.shape[1]):
                both = self.code[a, w][:, None] & plane[b, w][None, :]
                dot += np.bitwise_count(both).astype(np.float64) * (1 << p)
        # <signs, levels> with signs of -1 and 1, back to the scale of the components.
        signed = 2 * dot - self.levels[b][None, :]
        raw = signed * self.step[b] + np.outer(2 * self.ones[a] - self.dim, self.low[b])
        near = raw / np.sqrt(self.dim) / self.factor[a][:, None]
        f2 = np.minimum(self.factor[a] ** 2, 1.0)
        error = EPSILON * np.sqrt((1 - f2) / f2 / max(1, self.dim - 1))
        # Rounding moves each component by a step at most.
        rounding = EPSILON * 0.5 * self.step[b][None, :] / self.factor[a][:, None]
        inner = np.minimum(near + error[:, None] + rounding, 1.0)
        across = self.to_centre[a][:, None] + self.to_centre[b][None, :] - centre_norm2
        return across + self.length[a][:, None] * self.length[b][None, :] * inner


def linked_pairs(
    x: np.ndarray, centre: np.ndarray, rows: np.ndarray, cols: np.ndarray, cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (rows x cols, first below second where both lists are the same) linked."""
    unit = _unit_rows(x)
    codes = Codes(unit, centre)
    norm2 = float(centre @ centre)
    for at in range(0, len(rows), 256):
        some = rows[at : at + 256]
        i, j = np.nonzero(codes.upper_cosine(some, cols, norm2) >= cosine - 1e-9)
        i, j = some[i], cols[j]
        if rows is cols:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 65536):
            a, b = i[part : part + 65536], j[part : part + 65536]
            exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
            yield a[exact], b[exact]


def _link(centres, cosine: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_units(batches, _UNIT_COLUMNS):
            key = {c: rows[c].to_numpy() for c in _UNIT_COLUMNS}
            new = np.zeros(rows.num_rows, bool)
            new[0] = True
            for x in key.values():
                new[1:] |= x[1:] != x[:-1]
            starts = [*np.flatnonzero(new).tolist(), rows.num_rows]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if hi - lo < 2:
                    continue
                found = _unit_links(rows.slice(lo, hi - lo), centres.value, cosine)
                if found is not None:
                    yield found

    return compare


def _unit_links(rows: pa.Table, centres: dict, cosine: float) -> pa.RecordBatch | None:
    label, dim, cell, block_a, block_b = (rows[c][0].as_py() for c in _UNIT_COLUMNS)
    x = np.concatenate([c.flatten().to_numpy() for c in rows["vector"].chunks])
    x = x.reshape(-1, dim)
    rep, weight = rows["rep"].to_numpy(), rows["copies"].to_numpy()
    lives = rows["lives"].to_numpy()
    own = rows["own_block"].to_numpy()
    known = centres.get((label, dim))
    centre = np.zeros(dim) if known is None else known[cell]
    places = np.arange(len(x))
    if block_a == block_b:
        sides = [(places[lives], None), (places[lives], places[~lives])]
    else:
        a, b = lives & (own == block_a), lives & (own == block_b)
        sides = [(places[a], places[b]), (places[a], places[~lives])]
    links, parent = np.zeros(len(x), np.int64), places.copy()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for left, right in sides:
        if not len(left) or right is not None and not len(right):
            continue
        right = left if right is None else right
        for i, j in linked_pairs(x, centre, left, right, cosine):
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            # One new edge per row and batch suffices to connect it.
            for p, q in {(int(parent[p]), int(parent[q])) for p, q in zip(i, j, strict=True)}:
                p, q = root(p), root(q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
    hit = np.flatnonzero(links)
    if not len(hit):
        return None
    roots = np.array([rep[root(int(i))] for i in hit])
    return pa.RecordBatch.from_arrays(
        [pa.array(rep[hit]), pa.array(roots), pa.array(links[hit])], ["rep", "to", "links"]
    )


def near_duplicates(
    spark: SparkSession,
    rows: DataFrame,
    cosine: float = COSINE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of (vec_id, embedding, label)."""
    given = rows.select(
        "vec_id",
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    # Copies share a number; it is not an id, as ids may be null or repeat.
    fit = usable(given, "vector").where(
        F.col("label").isNotNull() & F.exists("vector", lambda v: v != 0)
    )
    classes = staged(
        spark,
        fit.groupBy("label", "vector")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
        .select(
            "label",
            F.size("vector").alias("dim"),
            F.xxhash64("label", "vector", F.lit(SEED)).alias("rep"),
            "vector",
            "copies",
            "first_id",
        ),
        "vector-classes",
    )
    n = classes.count()
    centres = spark.sparkContext.broadcast(fit_cells(classes, n, sample_rows))
    celled = classes.select("label", "dim", "rep", "vector", "copies").mapInArrow(
        _with_cells(centres, cosine),
        "label long, dim int, rep long, vector array<double>, copies long, cells array<int>",
    )
    placed = celled.select(
        "label", "dim", "rep", "vector", "copies", F.posexplode("cells").alias("nth", "cell")
    ).withColumn("lives", F.col("nth") == 0)
    units = in_cell_units(placed.drop("nth"))
    found = staged(
        spark,
        units.mapInArrow(_link(centres, cosine), "rep long, to long, links long"),
        "vector-links",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(
        spark, found.select(F.col("rep").alias("u"), F.col("to").alias("v"))
    )
    named = staged(
        spark,
        classes.select("label", "vector", "rep", "copies", "first_id")
        .join(links, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            "first_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("root"),
        ),
        "vector-components",
    )
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(ids, "root").select("label", "vector", "n_links", "component_id")
    alone = F.col("n_links").isNull()
    return (
        given.join(by_class, ["label", "vector"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
