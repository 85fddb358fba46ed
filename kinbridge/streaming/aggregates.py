"""Windowed aggregates of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinbridge.contracts import MONEY


def daily_fee(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Fee per tenant and UTC day.

    ``delay`` sets a watermark when the input has none yet.
    """
    if delay:
        events = events.withWatermark("event_time_ts", delay)
    return (
        events.groupBy(F.window("event_time_ts", "1 day"), "tenant")
        .agg(F.sum("platform_fee_usdt").cast(MONEY).alias("total_platform_fee_usdt"))
        .select(F.to_date("window.start").alias("event_date"), "tenant", "total_platform_fee_usdt")
    )


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The signed fee changes that ``load_warehouse`` publishes, as a stream."""
    schema = f"tenant string, event_date date, platform_fee_usdt {MONEY}, facts bigint"
    return spark.readStream.schema(schema).parquet(f"{path}/*")


def daily_fee_of_changes(changes: DataFrame) -> DataFrame:
    """Fee and number of unique facts per tenant and day, for update mode.

    A better repeat or a corrected customer comes as minus the old and plus the new row,
    however late; so the state, one row per tenant and day, is kept for all days.
    """
    return changes.groupBy("event_date", "tenant").agg(
        F.sum("platform_fee_usdt").cast(MONEY).alias("total_platform_fee_usdt"),
        F.sum("facts").alias("facts"),
    )


def active_customer_days(facts: DataFrame, delay: str = "1 day") -> DataFrame:
    """Distinct (event_date, canonical_customer_id) pairs.

    Counting distinct values exactly is not possible inside a stream; the pairs
    are, and the daily count over them is a small batch query.  A pair that
    returns after its state expired is a harmless repeat.
    """
    return (
        facts.where("canonical_customer_id IS NOT NULL")
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["event_date", "canonical_customer_id"])
        .select("event_date", "canonical_customer_id")
    )


def session_windows(
    events: DataFrame, key: str, ts: str, gap: str, delay: str | None = None
) -> DataFrame:
    """Runs of events without a pause longer than ``gap``; session_end is the last
    event plus the pause, as the stream cannot know earlier that it ended."""
    if delay:
        events = events.withWatermark(ts, delay)
    return (
        events.groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            key,
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "event_count",
        )
    )
