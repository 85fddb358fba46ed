"""The four raw inputs of one run."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Sources(NamedTuple):
    """Anything with these four attributes serves as the sources of a run."""

    pam_customers: DataFrame
    app_customers: DataFrame
    activity_events: DataFrame
    customer_sessions: DataFrame
