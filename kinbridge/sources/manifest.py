"""Onboarding tenants by configuration.

A manifest entry says where a tenant's files lie, how its columns are called and
which validation rules apply.  Tenants with the same column names share one
scan, so the plan grows with the number of layouts, not of tenants.

The files of an ``own_files`` entry hold rows of its tenant only: rows without a
tenant get it, rows of another one are rejected.  Whose file a row came from is
looked up by the file's folder, so such tenants share a scan too, as far as
their paths are equally deep.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinbridge.contracts import CORRUPT_COLUMN, OWNER, SOURCE_COLUMNS
from kinbridge.functions import blank_to_null
from kinbridge.sources.bundle import Sources


#: Sources whose rows name their tenant.
WITH_TENANT = tuple(name for name, columns in SOURCE_COLUMNS.items() if "tenant" in columns)

RULES = (
    "tenant string, source string, position int, column string, kind string, "
    "bound string, reason string"
)


class TenantRule(NamedTuple):
    """What one column of one source must keep; see ``plans.tenant_rules`` for the kinds."""

    source: str
    column: str
    kind: str
    #: Limit, pattern or list, as text.
    bound: str | None = None
    #: Label of rows that break the rule; made of kind and column if not given.
    reason: str | None = None


@dataclass(frozen=True)
class TenantEntry:
    tenant: str
    #: source name -> file or folder
    paths: Mapping[str, str]
    #: source name -> {contract column: column in this tenant's files}
    renames: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    #: Upper limit of the platform fee, as exact decimal text; None for no limit.
    max_platform_fee: str | None = None
    #: Whether this tenant's files hold rows of no other tenant.
    own_files: bool = False
    #: Rules of this tenant besides those that all rows must keep.
    rules: tuple[TenantRule, ...] = ()

    def layout(self, source: str) -> tuple[str, ...]:
        names = self.renames.get(source, {})
        return tuple(names.get(c, c) for c in SOURCE_COLUMNS[source])


def read_manifest(spark: SparkSession, path: str) -> list[TenantEntry]:
    """Entries from a small JSON configuration file, one tenant per line."""
    schema = (
        "tenant string, paths map<string,string>, "
        "renames map<string,map<string,string>>, max_platform_fee string, own_files boolean, "
        "rules array<struct<source string, column string, kind string, bound string, "
        "reason string>>"
    )
    rows = spark.read.schema(schema).json(path).collect()
    return [
        TenantEntry(
            r.tenant,
            r.paths or {},
            r.renames or {},
            r.max_platform_fee,
            bool(r.own_files),
            tuple(TenantRule(*rule) for rule in r.rules or ()),
        )
        for r in rows
    ]


def _read_layout(
    spark: SparkSession,
    source: str,
    layout: tuple[str, ...],
    depth: int | None,
    entries: list[TenantEntry],
) -> DataFrame:
    """One scan; with ``depth`` rows learn their owner from that many parts of their path."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*layout, CORRUPT_COLUMN)])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    raw = reader.json([e.paths[source] for e in entries])
    if depth is None:
        return raw.toDF(*SOURCE_COLUMNS[source], CORRUPT_COLUMN)
    owners = _owners(spark, source, entries)
    place = F.substring_index(_without_host("_metadata.file_path"), "/", depth)
    named = raw.select("*", place.alias("__place")).toDF(
        *SOURCE_COLUMNS[source], CORRUPT_COLUMN, "__place"
    )
    # One row per file or folder of the manifest, so the optimizer broadcasts it.
    owned = named.join(owners, "__place", "left").drop("__place")
    return owned.withColumn("tenant", F.coalesce(blank_to_null("tenant"), OWNER))


def _without_host(path: Column | str) -> Column:
    """A percent-encoded path without scheme and host."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def _place(spark: SparkSession, path: str) -> str:
    """A path like ``_without_host`` gives it."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(location).toUri().getRawPath().rstrip("/")


def _owners(spark: SparkSession, source: str, entries: list[TenantEntry]) -> DataFrame:
    places: dict[str, str] = {}
    for entry in entries:
        place = _place(spark, entry.paths[source])
        if places.setdefault(place, entry.tenant) != entry.tenant:
            raise ValueError(f"{place} belongs to {places[place]} and to {entry.tenant}")
    return spark.createDataFrame(list(places.items()), f"__place string, {OWNER} string")


def read_source(spark: SparkSession, source: str, entries: Iterable[TenantEntry]) -> DataFrame:
    layouts: dict[tuple[tuple[str, ...], int | None], list[TenantEntry]] = {}
    for entry in entries:
        if source in entry.paths:
            depth = None
            if entry.own_files and source in WITH_TENANT:
                if any(c in entry.paths[source] for c in "*?[{"):
                    raise ValueError(f"{entry.tenant}: own files need a path without wildcards")
                depth = _place(spark, entry.paths[source]).count("/") + 1
            layouts.setdefault((entry.layout(source), depth), []).append(entry)
    if not layouts:
        raise ValueError(f"no tenant provides {source}")
    parts = [_read_layout(spark, source, *lay, found) for lay, found in layouts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sources_from_manifest(spark: SparkSession, entries: list[TenantEntry]) -> Sources:
    return Sources(**{name: read_source(spark, name, entries) for name in SOURCE_COLUMNS})


def fee_limits(spark: SparkSession, entries: Iterable[TenantEntry]) -> DataFrame:
    """(tenant, max_platform_fee): one row per configured limit."""
    rows = [(e.tenant, e.max_platform_fee) for e in entries if e.max_platform_fee is not None]
    frame = spark.createDataFrame(rows, "tenant string, max_platform_fee string")
    return frame.withColumn("max_platform_fee", F.col("max_platform_fee").cast("decimal(38,18)"))


def tenant_rules(spark: SparkSession, entries: Iterable[TenantEntry]) -> DataFrame:
    """The manifest's rules as a table, numbered in their order."""
    rows = [
        (e.tenant, r.source, at, r.column, r.kind, r.bound, r.reason or f"{r.kind}_{r.column}")
        for e in entries
        for at, r in enumerate(e.rules)
    ]
    return spark.createDataFrame(rows, RULES)
