"""Logical plans: validation, identity, facts, KPIs, quality, whole runs."""
