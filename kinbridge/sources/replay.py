"""Replay of input files as messages: one non-blank line, one message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Columns topic, value.  The topic is the name of the file (or folder of
    part files) directly below ``folder``, without its extension."""
    lines = spark.read.option("recursiveFileLookup", "true").text(folder)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = files.makeQualified(place).toUri().getRawPath().rstrip("/")
    # Both paths are percent-encoded and without scheme and host.
    path = F.regexp_replace("_metadata.file_path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")
    encoded = F.substring_index(F.substr(path, F.lit(len(root) + 2)), "/", 1)
    first_part = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    stripped = F.regexp_replace("value", r"^\s+|\s+$", "")
    return lines.select(
        F.regexp_replace(first_part, r"\.[^.]*$", "").alias("topic"),
        stripped.alias("value"),
    ).where(F.col("value") != "")


def topic_counts(published: DataFrame) -> DataFrame:
    """Messages per topic plus a grand total under the NULL topic."""
    return published.rollup("topic").agg(F.count(F.lit(1)).alias("messages"))


def publish_to_folder(published: DataFrame, target: str) -> None:
    """One folder of text files per topic, for the file-based stream reader.

    The rebalance splits a topic holding most messages over several files.
    """
    published.hint("rebalance", "topic").write.partitionBy("topic").mode("overwrite").text(target)


def publish_to_kafka(published: DataFrame, bootstrap_servers: str) -> None:
    """Needs the Kafka connector of Spark on the class path."""
    (
        published.select("topic", F.col("value").cast("binary").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .save()
    )
