"""Source and warehouse contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
#: The tenant whose file a row came from, where a manifest says so.
OWNER = "file_tenant"

# Columns of each source, in source order.  All are strings, so
# that money reaches the exact decimal parser as text.
SOURCE_COLUMNS = {
    "pam_customers": (
        "pam_customer_id", "tenant", "full_name", "email_sha256", "country", "registered_at",
    ),
    "app_customers": ("app_customer_id", "username", "email_sha256", "created_at"),
    "activity_events": (
        "event_id", "app_customer_id", "tenant", "event_type", "event_time",
        "net_result_usdt", "platform_fee_usdt",
    ),
    "customer_sessions": (
        "session_id", "pam_customer_id", "login_at", "logout_at", "device", "ip_region",
    ),
}

MONEY = "decimal(38,18)"


def source_schema(name: str, *, keep_corrupt: bool = False) -> T.StructType:
    """All-string schema of one source, optionally with the unparseable line."""
    columns = SOURCE_COLUMNS[name] + ((CORRUPT_COLUMN,) if keep_corrupt else ())
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


@dataclass(frozen=True)
class TableContract:
    """One warehouse table: shape, keys and physical layout."""

    name: str
    ddl: str
    #: Rows with equal values here are versions of one logical row.
    natural_key: tuple[str, ...]
    #: Historic replace key, used in compat mode.
    wide_key: tuple[str, ...]
    #: The newest value of this column wins.
    version: str
    #: Date column whose month partitions the table.
    month_of: str | None = None
    #: Further partition columns (small, fixed domains only).
    partition_by: tuple[str, ...] = ()
    #: Columns that say where a row lies.  A version that moves a row leaves a withdrawn
    #: one at its old place, so that every place can be read by itself.
    place: tuple[str, ...] = ()
    #: Order of repeats as DDL: of one natural key the row of the least rank survives.
    rank: str | None = None
    #: Texts of the rank and the instants in it that they were parsed to.
    rank_texts: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    def key(self, by_natural_key: bool = True) -> tuple[str, ...]:
        return self.natural_key if by_natural_key else self.wide_key


# The four warehouse tables.
DIM_CUSTOMER = TableContract(
    name="dim_customer",
    ddl="""
        canonical_customer_id STRING NOT NULL,
        tenant STRING NOT NULL,
        email_sha256 STRING NOT NULL,
        full_name STRING,
        username STRING,
        country STRING,
        registered_at TIMESTAMP,
        first_seen_at TIMESTAMP NOT NULL,
        updated_at TIMESTAMP NOT NULL
    """,
    natural_key=("tenant", "canonical_customer_id"),
    wide_key=("tenant", "canonical_customer_id"),
    version="updated_at",
)

BRIDGE = TableContract(
    name="bridge_customer_identity",
    ddl="""
        canonical_customer_id STRING NOT NULL,
        tenant STRING NOT NULL,
        source_system STRING NOT NULL,
        source_customer_id STRING NOT NULL,
        email_sha256 STRING NOT NULL,
        linked_at TIMESTAMP NOT NULL
    """,
    natural_key=("tenant", "source_system", "source_customer_id"),
    wide_key=("tenant", "source_system", "source_customer_id"),
    version="linked_at",
    partition_by=("source_system",),
)

FACT_ACTIVITY = TableContract(
    name="fact_activity_event",
    ddl=f"""
        event_id STRING NOT NULL,
        app_customer_id STRING NOT NULL,
        canonical_customer_id STRING NOT NULL,
        tenant STRING NOT NULL,
        event_type STRING NOT NULL,
        event_time TIMESTAMP NOT NULL,
        event_date DATE NOT NULL,
        net_result_usdt {MONEY} NOT NULL,
        platform_fee_usdt {MONEY} NOT NULL,
        loaded_at TIMESTAMP NOT NULL
    """,
    natural_key=("event_id", "app_customer_id"),
    wide_key=("tenant", "event_date", "canonical_customer_id", "event_id", "app_customer_id"),
    version="loaded_at",
    month_of="event_date",
    place=("tenant", "event_date"),
    rank=f"""
        at TIMESTAMP, tenant STRING, event_type STRING, event_time STRING,
        net_result_usdt {MONEY}, platform_fee_usdt {MONEY}
    """,
    rank_texts=(("event_time", "at"),),
)

FACT_SESSION = TableContract(
    name="fact_customer_session",
    ddl="""
        session_id STRING NOT NULL,
        pam_customer_id STRING NOT NULL,
        canonical_customer_id STRING NOT NULL,
        tenant STRING NOT NULL,
        login_at TIMESTAMP NOT NULL,
        logout_at TIMESTAMP NOT NULL,
        session_date DATE NOT NULL,
        device STRING NOT NULL,
        ip_region STRING NOT NULL,
        loaded_at TIMESTAMP NOT NULL
    """,
    natural_key=("session_id",),
    wide_key=("tenant", "session_date", "canonical_customer_id", "session_id"),
    version="loaded_at",
    month_of="session_date",
    place=("tenant", "session_date"),
    rank="""
        login TIMESTAMP, logout TIMESTAMP, pam_customer_id STRING, login_at STRING,
        logout_at STRING, device STRING, ip_region STRING
    """,
    rank_texts=(("login_at", "login"), ("logout_at", "logout")),
)

WAREHOUSE = {t.name: t for t in (DIM_CUSTOMER, BRIDGE, FACT_ACTIVITY, FACT_SESSION)}
