"""Usable vectors of an embedding table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null or empty and has finite components only."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.where(x.isNotNull() & (F.size(x) > 0) & finite)
