"""Connected components by alternating large-star and small-star rounds.

Every round is joins and aggregations of edges; a hot node's edges are first reduced to
a minimum and then joined, where adaptive execution may split them.  The edges of each
round are written to the shared folder.  A round never adds edges, so their counted number
bounds its files.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.llm.common import staged

#: A round is written by one task for every so many edges: on Hadoop's local file system each
#: file and task folder starts a process, whatever its rows.
FILE_EDGES = 1 << 18


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    return (
        both.join(low, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node u to the smaller node v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(low, "u").where(F.col("v") != F.col("m"))
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(low.select("u", F.col("m").alias("v")))
        .distinct()
    )


def connected_components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge and is not its component's smallest.

    ``edges`` has two long columns, u and v; loops and repeats do not matter.
    """
    now = staged(
        spark,
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    for _ in range(rounds):
        if not mark[0]:
            break
        starred = _small_star(_large_star(now)).coalesce(ceil(mark[0] / FILE_EDGES))
        now = staged(spark, starred, "edges")
        before, mark = mark, now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if before == mark:
            break
    else:
        raise RuntimeError(f"no fixed components after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
