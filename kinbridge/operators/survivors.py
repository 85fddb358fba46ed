"""One row per key, chosen by a total order.

Both operators filter a ``row_number`` to its first row.  Catalyst turns that
into a group limit *before* the shuffle, so each task sends at most one row per
key: a key holding a third of all rows costs one row per input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """Keep the smallest row per key, by ``prefer`` and then by every other column.

    The order is total, so rows that differ anywhere always give the same
    survivor, whatever the order of the input.
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    return _first(df, keys, [F.col(c).asc() for c in [*prefer, *rest]])


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest version per key.

    Equal versions are decided by ``ties``, by default by every other column.
    Naming the few columns that can differ lets a reader that needs little of
    the row scan little of it.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != version]
    newest_first = [F.col(version).desc_nulls_last(), *(F.col(c).asc() for c in ties)]
    return _first(df, keys, newest_first)
