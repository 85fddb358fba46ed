"""Newline-delimited JSON with a fixed all-string schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinbridge.contracts import CORRUPT_COLUMN, SOURCE_COLUMNS, source_schema
from kinbridge.sources.bundle import Sources


def read_ndjson(
    spark: SparkSession, path: str | list[str], source: str, *, keep_corrupt: bool = True
) -> DataFrame:
    """Read one source; a line that is not JSON becomes a row of NULLs.

    With ``keep_corrupt`` that line's text stays available for the quarantine.
    """
    reader = spark.read.schema(source_schema(source, keep_corrupt=keep_corrupt))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.json(path)


def source_paths(folder: str) -> dict[str, str]:
    """``<folder>/<source>.json`` for each source: a file or a folder of files."""
    return {name: f"{folder.rstrip('/')}/{name}.json" for name in SOURCE_COLUMNS}


def sources_from_folder(spark: SparkSession, folder: str) -> Sources:
    return Sources(**{n: read_ndjson(spark, p, n) for n, p in source_paths(folder).items()})
