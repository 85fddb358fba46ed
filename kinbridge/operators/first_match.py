"""Ordered rules: a row carries the name of the first rule it breaks."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    #: Label given to a row that breaks the rule.
    reason: str
    #: SQL predicate that is true for a bad row.
    broken_when: str


def first_broken_rule(rules: Iterable[Rule]) -> Column:
    """The first matching reason, or NULL for a row that breaks none."""
    labels = [F.expr(f"IF({r.broken_when}, '{r.reason}', NULL)") for r in rules]
    return F.coalesce(*labels)
