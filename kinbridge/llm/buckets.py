"""Comparing the rows of a bucket without collecting large buckets in one task.

A bucket of up to ``block`` rows is one unit of work.  A larger one is cut into blocks by
a hash, and every two blocks (and every block with itself) become a unit, so that each
pair of rows meets in exactly one unit and no unit holds more than about two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinbridge.llm.common import small_side

UNIT = ("block_a", "block_b")


def in_units(rows: DataFrame, keys: list[str], salt: str, block: int) -> DataFrame:
    """``rows`` with columns block_a, block_b and own_block, dealt out and sorted by unit.

    ``salt`` names a column whose hash picks the block; equal values share one.
    """
    large = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = large.select(
        *(F.col(k).alias(f"large_{k}") for k in keys),
        F.ceil(F.col("n") / block).cast("int").alias("blocks"),
    )
    same = [F.col(k) == F.col(f"large_{k}") for k in keys]
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    cut = (
        rows.join(small_side(large), same, "left")
        .withColumn("own_block", F.pmod(F.xxhash64(salt, F.lit(7)), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("block_a", F.least("own_block", "other"))
        .withColumn("block_b", F.greatest("own_block", "other"))
        .select(*rows.columns, "own_block", *UNIT)
    )
    unit = [*keys, *UNIT]
    return cut.repartition(*unit).sortWithinPartitions(*unit)


def whole_units(batches: Iterator[pa.RecordBatch], unit: list[str]) -> Iterator[pa.Table]:
    """Tables of sorted rows, cut so that no unit is spread over two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1] for c in unit]
        # First row of the batch's last unit.
        at = batch.num_rows - 1
        low, high = 0, at
        while low < high:
            mid = (low + high) // 2
            if [batch.column(c)[mid] for c in unit] == last:
                high = mid
            else:
                low = mid + 1
        at = low
        if at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
        elif held and [held[0].column(c)[0] for c in unit] != last:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
