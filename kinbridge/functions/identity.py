"""The tenant-scoped canonical customer id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between tenant and email hash inside the hashed text.
SEPARATOR = ":"


def canonical_id(tenant: Column | str, email_sha256: Column | str) -> Column:
    """SHA-256 hex of ``tenant:email``.

    Missing parts are skipped, so callers that must not merge strangers check
    both parts first (see ``Semantics.validate_customers``).
    """
    parts = F.concat_ws(SEPARATOR, tenant, email_sha256)
    return F.sha2(parts, 256)
