"""Sessions of activity: runs of events of one customer without a long pause.

Events are first folded into bins no wider than the pause.  Any two events of
one bin are closer than the pause, so a bin never splits and plain partial
aggregation shrinks the data before the first shuffle.  Only the bins are then
ordered per customer: at most (covered time / pause) rows each, however many
events a hot customer has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def activity_sessions(
    df: DataFrame,
    key: str,
    ts: str,
    gap_seconds: int,
    *,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Columns: key, session_start, session_end (last event), event_count, sums.

    A pause of exactly ``gap_seconds`` still belongs to the session.  One key leaves at
    most (covered time / pause) bins in one task, so the pause must not be tiny.
    """
    if gap_seconds <= 0:
        raise ValueError("gap_seconds must be positive")
    sums = sums or {}
    gap_micros = gap_seconds * 1_000_000
    bins = (
        df.where(F.col(ts).isNotNull())
        .withColumn("__at", F.unix_micros(F.col(ts).cast("timestamp")))
        .withColumn("__bin", F.col("__at") - F.pmod(F.col("__at"), F.lit(gap_micros)))
        .groupBy(key, "__bin")
        .agg(
            F.min("__at").alias("__first"),
            F.max("__at").alias("__last"),
            F.count(F.lit(1)).alias("event_count"),
            *(F.sum(value).alias(name) for name, value in sums.items()),
        )
    )
    by_time = Window.partitionBy(key).orderBy("__bin")
    pause = F.col("__first") - F.lag("__last").over(by_time)
    opened = bins.withColumn(
        "__opens", F.when(pause <= gap_micros, F.lit(0)).otherwise(F.lit(1))
    )
    numbered = opened.withColumn("__session", F.sum("__opens").over(by_time))
    return (
        numbered.groupBy(key, "__session")
        .agg(
            F.timestamp_micros(F.min("__first")).alias("session_start"),
            F.timestamp_micros(F.max("__last")).alias("session_end"),
            F.sum("event_count").alias("event_count"),
            *(F.sum(name).alias(name) for name in sums),
        )
        .drop("__session")
    )
