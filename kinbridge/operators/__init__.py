"""Reusable DataFrame-to-DataFrame operators."""

from kinbridge.operators.first_match import Rule, first_broken_rule
from kinbridge.operators.gaps import activity_sessions
from kinbridge.operators.survivors import latest_version, one_per_key

__all__ = ["Rule", "activity_sessions", "first_broken_rule", "latest_version", "one_per_key"]
