"""Mixing sources to target weights, in DataFrame functions only.

The size of a document is its number of words.  Sources in code point order, null last,
weigh 5, 2, 1, repeating; a source's target is its weight's share of all words, but at
most ``MAX_REPEATS`` times its own words, and what that leaves over is shared by weight
among the others.

A hash cuts every source into blocks.  As often as a source fits wholly into its target
all its blocks are drawn; of the rest, blocks in hashed order as long as they fit, and of
the first that does not, single documents that fit.  The exact numbers of block draws per
source are then split among the output shards by a tree: at each node the left half's
vector of quotas is drawn from the multivariate hypergeometric distribution, one source
after the other, by inversion of a hashed uniform.  Each shard takes its quota from the
source's permuted draws, so draws are disjoint, and is shuffled by itself.

Null texts have size 0.  Documents without words belong to blocks as all others and take
no words.  Every row is drawn by itself: rows of equal id, source and text are numbered, and
number and values are hashed together.  Which of them gets which number does not matter, so
reruns agree, whatever ids are missing or repeat.  An empty table gives
no rows.  Texts of any length that fits a task are counted whole.  Other columns, whatever
their names, are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from kinbridge.llm.common import small_side, staged

#: Weights by place of the source, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20_240_501
DOCS_PER_BLOCK = 128
#: Blocks of one source; beyond it blocks grow, so no window over blocks grows further.
MAX_BLOCKS = 1 << 20
WORDS_PER_SHARD = 8_000_000
MAX_SHARDS = 4096

WORD = r"[^\x20\x09-\x0D]+"


def size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _same() -> Column:
    return F.xxhash64("doc_id", "source", "text", F.lit(SEED))


def numbered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Gives every row a ``key`` of its own from its ``same``, which equal rows share.

    Only rows whose ``same`` repeats are numbered: within the task that wrote them, from
    where the tasks before ended.  So the copies of one row, even if they are a third of all
    rows, are counted by their tasks and never meet in one.
    """
    repeated = staged(
        spark,
        rows.groupBy("same").agg(F.count("*").alias("n")).where("n > 1").select("same"),
        "mix-repeated",
    )
    n_repeated = repeated.count()
    key = lambda number: F.xxhash64("same", number, F.lit(SEED))
    if not n_repeated:
        return rows.withColumn("key", key(_long(0))).drop("same")
    known = small_side(repeated, n_repeated)
    copies = staged(
        spark,
        rows.join(known, "same", "left_semi").withColumn("task", F.spark_partition_id()),
        "mix-copies",
    )
    by_task = Window.partitionBy("same").orderBy("task")
    starts = (
        copies.groupBy("same", "task")
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.sum("n").over(by_task) - F.col("n"))
        .drop("n")
    )
    inside = F.row_number().over(Window.partitionBy("same", "task").orderBy(F.lit(0)))
    counted = (
        copies.withColumn("inside", inside)
        .join(starts, ["same", "task"])
        .withColumn("key", key(F.col("start") + F.col("inside")))
    )
    single = rows.join(known, "same", "left_anti").withColumn("key", key(_long(0)))
    columns = [c for c in single.columns if c != "same"]
    return single.select(*columns).unionByName(counted.select(*columns))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _long(x) -> Column:
    return F.lit(x).cast("long") if not isinstance(x, Column) else x.cast("long")


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` items, out of ``total``, are among the ``marked`` ones.

    Inverts the distribution at the uniform ``u``, from the mode upwards and then
    downwards.  Terms beyond twelve deviations are below the precision of a double.
    """

    def inside(s: Column) -> Column:
        n, k, m, v = s["n"], s["k"], s["m"], s["u"]
        share = k.cast("double") / F.greatest(n, _long(1))
        spread = F.sqrt(m * share * (1 - share)) * 12 + 24
        low, high = F.greatest(_long(0), m - (n - k)), F.least(k, m)
        mode = F.least(high, F.greatest(low, F.floor((k + 1.0) * (m + 1.0) / (n + 2.0))))
        return _let(
            F.struct(
                n.alias("n"), k.alias("k"), m.alias("m"), v.alias("u"), mode.alias("at"),
                F.greatest(low, _long(F.floor(mode - spread))).alias("low"),
                F.least(high, _long(F.ceil(mode + spread))).alias("high"),
            ),
            search,
        )

    def search(s: Column) -> Column:
        n, k, m, at = s["n"], s["k"], s["m"], s["at"]
        # Weight of x from that of x - 1, and of x from that of x + 1.
        up = lambda x: ((k - x + 1.0) * (m - x + 1.0)) / (x * (n - k - m + x * 1.0))
        down = lambda x: ((x + 1.0) * (n - k - m + x + 1.0)) / ((k - x) * (m - x * 1.0))
        nothing = F.array().cast("array<bigint>")
        above = F.when(s["high"] > at, F.sequence(at + 1, s["high"])).otherwise(nothing)
        below = F.when(s["low"] < at, F.sequence(at - 1, s["low"], _long(-1))).otherwise(nothing)
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))

        def mass(xs: Column, ratio) -> Column:
            def add(a: Column, x: Column) -> Column:
                w = a["w"] * ratio(x)
                return F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))

            return F.aggregate(xs, start, add)["sum"]

        goal = s["u"] * (1.0 + mass(above, up) + mass(below, down))

        def walk(xs: Column, ratio, begin: Column) -> Column:
            def add(a: Column, x: Column) -> Column:
                w = a["w"] * ratio(x)
                here = (a["left"] >= 0) & (a["left"] - w < 0)
                return F.struct(
                    w.alias("w"),
                    F.when(a["left"] >= 0, a["left"] - w).otherwise(a["left"]).alias("left"),
                    F.when(here, x).otherwise(a["x"]).alias("x"),
                )

            return F.aggregate(xs, begin, add)

        first = F.struct(
            F.lit(1.0).alias("w"), (goal - 1.0).alias("left"), at.cast("long").alias("x")
        )
        return _let(
            walk(above, up, first),
            lambda a: walk(
                below, down, F.struct(F.lit(1.0).alias("w"), a["left"].alias("left"), a["x"].alias("x"))
            )["x"],
        )

    return _let(
        F.struct(
            _long(total).alias("n"), _long(marked).alias("k"), _long(drawn).alias("m"), u.alias("u")
        ),
        inside,
    )


def _uniform(*values: Column) -> Column:
    """A hashed double in [0, 1) of 53 bits."""
    bits = F.shiftrightunsigned(F.xxhash64(*values, F.lit(SEED)), 11)
    return bits.cast("double") / float(1 << 53)


def quota_tree(root: DataFrame, shards: int) -> DataFrame:
    """Splits the one row of quotas (array ``quota``) into rows (shard, quota)."""
    zero = _long(0)
    nodes = root.select(
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.col("quota").cast("array<bigint>")
    )
    for level in range(max(0, math.ceil(math.log2(shards)))):
        if level == 6:
            nodes = nodes.repartition("lo")  # many nodes, each a fold over all sources
        total = F.aggregate("quota", zero, lambda a, x: a + x)
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        share = (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))
        numbered = F.zip_with(
            "quota",
            F.sequence(F.lit(0), F.size("quota") - 1),
            lambda q, i: F.struct(q.alias("q"), i.alias("i")),
        )

        def draw(a: Column, x: Column) -> Column:
            u = _uniform(F.col("lo"), F.col("hi"), x["i"])
            return _let(
                hypergeometric(a["n"], x["q"], a["m"], u),
                lambda got: F.struct(
                    (a["n"] - x["q"]).alias("n"),
                    (a["m"] - got).alias("m"),
                    F.concat(a["out"], F.array(got)).alias("out"),
                ),
            )

        begin = F.struct(
            total.alias("n"),
            _long(F.floor(total * share)).alias("m"),
            F.array().cast("array<bigint>").alias("out"),
        )
        left = F.when(
            F.size("quota") > 0, F.aggregate(numbered, begin, draw)["out"]
        ).otherwise(F.array().cast("array<bigint>"))
        split = nodes.select("lo", "hi", mid.alias("mid"), "quota", left.alias("left"))
        right = F.zip_with("quota", "left", lambda q, x: q - x)
        nodes = split.select(
            F.explode(
                F.when(
                    F.col("hi") - F.col("lo") > 1,
                    F.array(
                        F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("quota")),
                        F.struct(F.col("mid").alias("lo"), F.col("hi"), right.alias("quota")),
                    ),
                ).otherwise(F.array(F.struct("lo", "hi", "quota")))
            ).alias("node")
        ).select("node.*")
    return nodes.select(F.col("lo").alias("shard"), "quota")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, docs) with place, weight and target.

    Sorted by the level at which a source reaches its ceiling, the first one whose ceiling
    lies above the level that the rest would get ends the capped ones.
    """
    everything = Window.partitionBy()
    ceiling = F.col("source_size") * MAX_REPEATS
    placed = sizes.withColumn(
        "place", F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    ).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("place") % len(WEIGHTS) + 1)
    )
    by_level = everything.orderBy(ceiling / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    levelled = (
        placed.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum(ceiling).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("free", ceiling * F.col("open") >= F.col("weight") * (F.col("all") - F.col("capped")))
    )
    # All sources from the first free one on share the level found there.
    first = F.min(F.when(F.col("free"), F.struct("rank", "capped", "open"))).over(everything)
    return (
        levelled.withColumn("rank", F.row_number().over(by_level))
        .withColumn("first", first)
        .withColumn(
            "target",
            F.when(
                F.col("rank") >= F.col("first.rank"),
                F.col("weight") * (F.col("all") - F.col("first.capped")).cast("double")
                / F.col("first.open"),
            ).otherwise(ceiling.cast("double")),
        )
        .select("source", "source_size", "docs", "place", "target")
    )


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def plan(spark: SparkSession, digest: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Sources with targets, drawn blocks with their shards, and the number of shards.

    ``digest`` has source, size and key of every row.  A drawn block has the shards of
    its whole draws, and the shard and the keys of its partial one.
    """
    sizes = digest.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("docs")
    )
    sources = staged(
        spark,
        targets(sizes)
        .withColumn(
            "blocks",
            F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("docs") / DOCS_PER_BLOCK)).cast("int"),
        )
        .withColumn(
            "passes",
            F.when(
                F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
            ).otherwise(0).cast("int"),
        )
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "mix-sources",
    )
    small = small_side(sources)
    all_words = sources.agg(F.sum("source_size")).first()[0] or 0
    shards = min(MAX_SHARDS, max(1, math.ceil(all_words / WORDS_PER_SHARD)))

    blocked = digest.alias("d").join(small.alias("s"), _same_source("d", "s")).select(
        "d.source", "d.size", "d.key", F.pmod("d.key", "s.blocks").cast("int").alias("block")
    )
    sums = blocked.groupBy("source", "block").agg(F.sum("size").alias("size"))
    in_order = Window.partitionBy("source").orderBy(
        F.xxhash64("block", F.lit(SEED)), "block"
    )
    cut = staged(
        spark,
        sums.alias("b")
        .join(small.alias("s"), _same_source("b", "s"))
        .select("b.source", "b.block", "b.size", "s.place", "s.passes", "s.rest")
        .withColumn("end", F.sum("size").over(in_order))
        .withColumn("whole", F.col("passes") + (F.col("end") <= F.col("rest")).cast("int"))
        .withColumn(
            "part", (F.col("end") > F.col("rest")) & (F.col("end") - F.col("size") < F.col("rest"))
        ),
        "mix-blocks",
    )
    # One block per source: documents in hashed order, each if it still fits.
    open_blocks = cut.where("part").select(
        "source", "block", (F.col("rest") - F.col("end") + F.col("size")).alias("room")
    )

    def fit(a: Column, x: Column) -> Column:
        fits = (x["size"] > 0) & (x["size"] <= a["room"])
        return F.struct(
            F.when(fits, a["room"] - x["size"]).otherwise(a["room"]).alias("room"),
            F.when(fits, F.concat(a["keys"], F.array(x["key"]))).otherwise(a["keys"]).alias("keys"),
        )

    nothing = F.array().cast("array<bigint>")
    parts = (
        blocked.alias("d")
        .join(
            small_side(open_blocks).alias("o"),
            _same_source("d", "o") & (F.col("d.block") == F.col("o.block")),
        )
        .groupBy("d.source", "d.block", "d.key", "o.room")
        .agg(F.sum("d.size").alias("size"))  # rows of one key are drawn alike
        .groupBy("source", "block", "room")
        .agg(F.array_sort(F.collect_list(F.struct("key", "size"))).alias("docs"))
        .select(
            "source",
            "block",
            F.aggregate(
                "docs", F.struct(F.col("room"), nothing.alias("keys")), fit
            )["keys"].alias("keys"),
        )
    )
    drawn = (
        cut.alias("c")
        .join(
            parts.alias("p"),
            _same_source("c", "p") & (F.col("c.block") == F.col("p.block")),
            "left",
        )
        .select("c.source", "c.place", "c.block", "c.whole", "p.keys")
        .withColumn("draws", F.col("whole") + F.coalesce(F.size("keys") > 0, F.lit(False)).cast("int"))
        .where("draws > 0")
    )
    draws = staged(
        spark,
        drawn.withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("draws")))).withColumn(
            "turn",
            F.row_number().over(
                Window.partitionBy("place").orderBy(
                    F.xxhash64("block", "draw", F.lit(SEED + 1)), "block", "draw"
                )
            ),
        ),
        "mix-draws",
    )
    quota = draws.groupBy("place").agg(F.count("*").alias("n"))
    root = quota.agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("by_place"))
    tree = quota_tree(root.select(F.col("by_place.n").alias("quota")), shards)
    names = root.select(F.col("by_place.place").alias("places"))
    ends = (
        tree.select("shard", F.posexplode("quota").alias("at", "n"))
        .groupBy("at")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("by_shard"))
        .join(names.select(F.posexplode("places").alias("at", "place")), "at")
        .select(
            "place",
            F.aggregate(
                "by_shard.n",
                nothing,
                lambda a, n: F.concat(a, F.array(n + F.coalesce(F.try_element_at(a, F.lit(-1)), _long(0)))),
            ).alias("ends"),
        )
    )
    blocks = staged(
        spark,
        draws.join(small_side(ends, sources.count() * shards), "place")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("turn"))))
        .groupBy("source", "block")
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("draw") <= F.col("whole"), F.col("shard")))
            ).alias("shards"),
            F.max(F.when(F.col("draw") > F.col("whole"), F.col("shard"))).alias("part_shard"),
            F.max(F.when(F.col("draw") > F.col("whole"), F.col("keys"))).alias("part_keys"),
        ),
        "mix-plan",
    )
    return sources, blocks, shards


def _placed(docs: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (doc struct, size, key) with source figures and the shards of their copies."""
    placed = docs.alias("d").join(
        small_side(sources).alias("s"), F.col("d.doc.source").eqNullSafe(F.col("s.source"))
    ).select(
        "d.doc", "d.size", "d.key", "s.source_size", "s.target",
        F.col("d.doc.source").alias("source"),
        F.pmod("d.key", "s.blocks").cast("int").alias("block"),
    )
    partial = F.array_contains("part_keys", F.col("key"))
    none = F.array().cast("array<int>")
    return (
        placed.alias("d")
        .join(
            small_side(blocks).alias("b"),
            _same_source("d", "b") & (F.col("d.block") == F.col("b.block")),
            "left",
        )
        .select(
            "d.doc", "d.size", "d.key", "d.source_size", "d.target",
            F.concat(
                F.coalesce("shards", none),
                F.when(partial, F.array("part_shard")).otherwise(none),
            ).alias("shards"),
        )
    )


def _sized(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows (doc struct, size, key)."""
    rows = docs.select(F.struct("*").alias("doc"), size().alias("size"), _same().alias("same"))
    return numbered(spark, rows)


def draws(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every document's id, size, source_size, target, and shards of its copies."""
    rows = staged(
        spark,
        docs.select("doc_id", "source", size().alias("size"), _same().alias("same")),
        "mix-sizes",
    )
    digest = staged(spark, numbered(spark, rows), "mix-digest")
    sources, blocks, _ = plan(spark, digest)
    found = digest.select(F.struct("doc_id", "source").alias("doc"), "size", "key")
    return _placed(found, sources, blocks).select(
        "doc.doc_id", "size", "source_size", "target", "shards"
    )


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mixed rows, as often as drawn, shard by shard in shuffled order."""
    sized = _sized(spark, docs)
    digest = staged(spark, sized.select("doc.source", "size", "key"), "mix-digest")
    sources, blocks, shards = plan(spark, digest)
    copies = _placed(sized, sources, blocks).select(
        "doc", "key", F.posexplode("shards").alias("copy", "shard")
    )
    copies = copies.withColumn("turn", F.xxhash64("key", "copy", F.lit(SEED + 2)))
    ordered = copies.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", "turn", "key"
    )
    return ordered.select("doc.*")
