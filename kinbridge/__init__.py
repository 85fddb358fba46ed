"""Customer activity warehouse on PySpark: validation, identity, facts, KPIs."""

from kinbridge.options import COMPAT, STRICT, Semantics

__all__ = ["COMPAT", "STRICT", "Semantics"]
