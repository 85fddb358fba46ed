"""Inputs: NDJSON files, existing tables, tenant manifests, message replay."""

from kinbridge.sources.bundle import Sources
from kinbridge.sources.from_tables import sources_from_tables
from kinbridge.sources.manifest import TenantEntry, sources_from_manifest
from kinbridge.sources.ndjson import read_ndjson, sources_from_folder

__all__ = [
    "Sources",
    "TenantEntry",
    "read_ndjson",
    "sources_from_folder",
    "sources_from_manifest",
    "sources_from_tables",
]
