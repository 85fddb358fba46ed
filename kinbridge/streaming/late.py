"""Late rows of a stream, kept.

A stateful step drops what comes behind its watermark and only counts it.  Here a query
without state runs before it: it knows the watermark that earlier batches have set, passes
on the rows that are in time, and quarantines the others with their payload.  The next
query reads what was passed on; its watermark is never ahead of this one, so it drops
nothing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from kinbridge import workspace
from kinbridge.plans.validation import REASON, accepted, rejected
from kinbridge.sinks import quarantine, warehouse
from kinbridge.streaming.activity import SOURCE

LATE = "late_event"
_MARK = "latest timestamp"


def _latest_before(spark: SparkSession, marks: str, batch_id: int) -> datetime | None:
    """The latest event time of all earlier batches: each mark has that of its past."""
    path = f"{marks}/batch-{batch_id - 1}"
    if not warehouse.exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema(_MARK).parquet(path).first()["latest"]


def set_late_aside(
    labelled: DataFrame,
    path: str,
    quarantine_path: str,
    checkpoint: str,
    delay: timedelta = timedelta(days=1),
    name_of_stream: str = "late",
) -> DataStreamWriter:
    """Splits every batch of labelled events by the watermark of the batches before it.

    Events in time go to ``path``, one folder per batch, for ``read_in_time``; late ones
    (and rejected rows) to the quarantine.  A batch that comes again writes the same.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = workspace.new_folder(spark, "in-time")
        batch.write.parquet(stage)
        rows = spark.read.schema(batch.schema).parquet(stage)
        before = _latest_before(spark, f"{path}/marks", batch_id)
        good = accepted(rows)
        # A row on the watermark is late, as in Spark's own operators.
        late = F.lit(False) if before is None else F.col("event_time_ts") <= F.lit(before - delay)
        name = f"{name_of_stream}-{batch_id}"
        held = good.where(late).withColumn(REASON, F.lit(LATE))
        bad = quarantine.as_quarantine(rejected(rows), SOURCE, load_id=name).unionByName(
            quarantine.as_quarantine(held, SOURCE, load_id=name)
        )
        quarantine.make_table(spark, quarantine_path)
        quarantine.append_new(bad, quarantine_path)
        good.where(~late).write.mode("overwrite").parquet(f"{path}/rows/batch-{batch_id}")
        latest = F.greatest(F.max("event_time_ts"), F.lit(before).cast("timestamp"))
        mark = good.agg(latest.alias("latest"))
        mark.write.mode("overwrite").parquet(f"{path}/marks/batch-{batch_id}")
        workspace.remove(spark, stage)

    return (
        labelled.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(split)
    )


def read_in_time(spark: SparkSession, path: str, schema) -> DataFrame:
    """Accepted events that ``set_late_aside`` passed on, as a stream."""
    return spark.readStream.schema(schema).parquet(f"{path}/rows/*")
