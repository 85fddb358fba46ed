"""Structured Streaming versions of the activity path."""

from kinbridge.streaming.activity import (
    LateRows,
    label_stream,
    late_rows,
    read_events,
    unique_in_stream,
    with_customers,
)
from kinbridge.streaming.aggregates import (
    active_customer_days,
    daily_fee,
    daily_fee_of_changes,
    read_changes,
    session_windows,
)
from kinbridge.streaming.late import read_in_time, set_late_aside
from kinbridge.streaming.sink import (
    load_warehouse,
    read_batches,
    run_available,
    run_continuously,
    write_batches,
)

__all__ = [
    "LateRows",
    "active_customer_days",
    "daily_fee",
    "daily_fee_of_changes",
    "label_stream",
    "late_rows",
    "load_warehouse",
    "read_batches",
    "read_changes",
    "read_events",
    "read_in_time",
    "run_available",
    "run_continuously",
    "session_windows",
    "set_late_aside",
    "unique_in_stream",
    "with_customers",
    "write_batches",
]
