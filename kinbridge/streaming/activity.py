"""Validation, de-duplication and identity of an event stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinbridge.contracts import CORRUPT_COLUMN, source_schema
from kinbridge.options import STRICT, Semantics
from kinbridge.plans import facts
from kinbridge.plans.validation import EVENT_KEY, accepted_events, label_events

SOURCE = "activity_events"


def read_events(
    spark: SparkSession,
    location: str,
    source: str = "json",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw events as a stream, in the all-string source contract.

    ``json``: a folder that receives NDJSON files.  ``kafka``: ``location`` is
    the bootstrap server list; it needs Spark's Kafka connector.  Limit the
    intake of one trigger with ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``;
    that also bounds what a hot key can bring to one task.
    """
    schema = source_schema(SOURCE, keep_corrupt=True)
    if source == "kafka":
        stream = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", SOURCE)
            .options(**dict(options or {}))
            .load()
        )
        parser = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
        parsed = F.from_json(F.col("value").cast("string"), schema, parser)
        return stream.select(parsed.alias("row")).select("row.*")
    reader = spark.readStream.schema(schema).options(**dict(options or {}))
    return reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(location)


def label_stream(raw: DataFrame, sem: Semantics = STRICT) -> DataFrame:
    """Same labels as in batch: the rules look at one row at a time."""
    return label_events(raw, sem)


def unique_in_stream(labelled: DataFrame, delay: str = "1 day") -> DataFrame:
    """Accepted events, one per natural key among events less than ``delay`` apart.

    Rows without a usable time are already rejected, so every row can be
    judged by the watermark and the state stays bounded.  A repeat that comes
    after the watermark is caught by the idempotent sink.
    """
    return (
        accepted_events(labelled)
        .withWatermark("event_time_ts", delay)
        .dropDuplicatesWithinWatermark(list(EVENT_KEY))
    )


def with_customers(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Stream-static join with the bridge; stateless, a miss keeps the event."""
    return facts.activity_facts(events, bridge)


class LateRows:
    """Counts the rows a query dropped for being behind the watermark.

    A query keeps its last progress reports only, so they are added up while it runs;
    ``update`` must be called more often than reports are dropped.
    """

    def __init__(self) -> None:
        self.total = 0
        self._seen: tuple[str, int] | None = None

    def update(self, query: StreamingQuery) -> int:
        run = str(query.runId)
        last = self._seen[1] if self._seen and self._seen[0] == run else -1
        for progress in query.recentProgress:
            if progress.batchId > last:
                last = progress.batchId
                self.total += sum(
                    op.numRowsDroppedByWatermark for op in progress.stateOperators
                )
        self._seen = (run, last)
        return self.total


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped for being behind the watermark, in the reports the query still has.

    ``LateRows`` counts all of a run of any length.
    """
    return LateRows().update(query)
