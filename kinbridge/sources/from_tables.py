"""Customer activity sources derived from order and event tables.

Customers become accounts, events become activity, orders become sessions.
Every table is read whole.  Fixed fractions of rows get the defects that the
validation and identity rules must handle, always as a function of the row's
key, so that any engine derives the same text.

Every source is a row-local projection of its table (copies come from
``explode``), hence the same code serves batch and streaming reads.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _each(key: str, every: int, remainder: int) -> Column:
    return (F.col(key) % every) == remainder


def _case(otherwise: Column, *branches: tuple[Column, str | Column | None]) -> Column:
    expr = None
    for condition, value in branches:
        value = value if isinstance(value, Column) else F.lit(value).cast("string")
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
    return expr.otherwise(otherwise)


def _copies(*conditions: Column) -> Column:
    """Copy numbers of a row: 0, and i+1 for each condition i that holds."""
    extra = [F.when(c, F.lit(i + 1)) for i, c in enumerate(conditions)]
    return F.explode(F.array_compact(F.array(F.lit(0), *extra)))


def _email(owner: Column) -> Column:
    return F.sha2(F.concat(owner, F.lit("@mail")), 256)


def pam_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Two accounts per person; some in a second tenant or with a second email."""
    key = F.col("c_custkey")
    person = F.expr("c_custkey div 2")
    rows = (
        customer.select("c_custkey", "c_name", "c_nationkey")
        .withColumn("person", person)
        .withColumn(
            "home",
            F.when(_each("c_custkey", 17, 3), F.col("c_nationkey")).otherwise(
                F.col("person") % 25
            ),
        )
        .join(nation.select("n_nationkey", "n_name"), F.col("home") == F.col("n_nationkey"), "left")
        .withColumn(
            "copy",
            _copies(
                _each("c_custkey", 101, 4), _each("c_custkey", 103, 2), _each("c_custkey", 107, 6)
            ),
        )
    )
    owner = F.concat(F.lit("person-"), F.col("person").cast("string"))
    registered = F.make_timestamp_ntz(*(F.lit(v) for v in (2023, 1, 1, 8, 0, 0))) + F.make_dt_interval(
        days=(key % 300).cast("int")
    )
    return rows.select(
        _case(
            F.concat(F.lit("TG-"), key.cast("string")), (_each("c_custkey", 211, 5), None)
        ).alias("pam_customer_id"),
        _case(
            F.concat(F.lit("tenant-"), (F.col("person") % 3).cast("string")),
            (F.col("copy") == 1, "tenant-9"),
            (_each("c_custkey", 223, 7), None),
            (_each("c_custkey", 227, 9), "ten:ant"),
            (_each("c_custkey", 229, 11), "  "),
        ).alias("tenant"),
        _case(
            F.concat(F.lit("Person "), F.col("person").cast("string")),
            (_each("c_custkey", 17, 3), F.col("c_name")),
        ).alias("full_name"),
        _case(
            _email(owner),
            (F.col("copy") == 2, _email(F.concat(F.lit("alt-"), key.cast("string")))),
            (_each("c_custkey", 53, 13), None),
        ).alias("email_sha256"),
        F.col("n_name").alias("country"),
        _case(
            F.date_format(registered, ISO_SECONDS),
            (_each("c_custkey", 61, 17), "not-a-date"),
            (_each("c_custkey", 67, 19), None),
        ).alias("registered_at"),
    )


def app_customers(customer: DataFrame) -> DataFrame:
    """One account per customer key; one in five belongs to nobody in PAM."""
    key = F.col("c_custkey")
    number = key.cast("string")
    created = F.make_timestamp_ntz(*(F.lit(v) for v in (2023, 6, 1, 9, 30, 0))) + F.make_dt_interval(
        days=(key % 200).cast("int")
    )
    return customer.select(
        _case(F.concat(F.lit("PK-"), number), (_each("c_custkey", 211, 15), None)).alias(
            "app_customer_id"
        ),
        F.concat(F.lit("user_"), number).alias("username"),
        _case(
            _email(F.concat(F.lit("person-"), number)),
            (_each("c_custkey", 59, 21), None),
            (_each("c_custkey", 5, 4), _email(F.concat(F.lit("solo-"), number))),
        ).alias("email_sha256"),
        F.date_format(created, ISO_SECONDS).alias("created_at"),
    )


def activity_events(events: DataFrame) -> DataFrame:
    """One activity per event, with exact and with differing repeats."""
    rows = events.select("event_id", "ts", "user_id", "event_type", "value").withColumn(
        "copy",
        _copies(_each("event_id", 20, 1), _each("event_id", 50, 2), _each("event_id", 70, 3)),
    )
    cents = F.col("value").cast("decimal(18,2)")
    fee = (cents * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(18,4)")
    fee = F.when(F.col("copy") == 2, (fee + F.lit(1)).cast("decimal(18,4)")).otherwise(fee)
    net = (cents - F.lit(100).cast("decimal(18,2)")).cast("decimal(18,2)").cast("string")
    at = F.col("ts").cast("timestamp_ntz")
    at = F.when(F.col("copy") == 3, at - F.expr("INTERVAL '1' HOUR")).otherwise(at)
    user = F.col("user_id").cast("string")
    return rows.select(
        _case(
            F.concat(F.lit("E-"), F.col("event_id").cast("string")),
            (_each("event_id", 211, 0), None),
            (_each("event_id", 499, 3), ""),
        ).alias("event_id"),
        _case(
            F.concat(F.lit("PK-"), user),
            (_each("event_id", 103, 0), None),
            (_each("event_id", 401, 7), F.concat(F.lit("PK-ghost-"), user)),
        ).alias("app_customer_id"),
        _case(
            F.concat(F.lit("tenant-"), (F.col("user_id") % 3).cast("string")),
            (_each("event_id", 307, 1), None),
            (
                _each("user_id", 7, 3) & _each("event_id", 13, 0),
                F.concat(F.lit("tenant-"), ((F.col("user_id") + 1) % 3).cast("string")),
            ),
        ).alias("tenant"),
        F.col("event_type"),
        _case(
            F.date_format(at, ISO_MILLIS),
            (_each("event_id", 101, 0), None),
            (_each("event_id", 397, 5), "soon"),
            (_each("event_id", 503, 9), ""),
        ).alias("event_time"),
        _case(net, (_each("event_id", 97, 0), F.concat(net, F.lit("X")))).alias("net_result_usdt"),
        _case(
            fee.cast("string"),
            (_each("event_id", 89, 0), "-0.30"),
            (_each("event_id", 409, 11), "n/a"),
            (_each("event_id", 113, 0), "0E-18"),
        ).alias("platform_fee_usdt"),
    )


def customer_sessions(orders: DataFrame) -> DataFrame:
    """One session per order."""
    key = F.col("o_orderkey")
    rows = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    ).withColumn("copy", _copies(_each("o_orderkey", 30, 1)))
    login = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=key % 86400)
    logout = login + F.make_dt_interval(mins=((key % 7 - 1) * 10).cast("int"))
    customer = F.col("o_custkey").cast("string")
    return rows.select(
        _case(
            F.concat(F.lit("S-"), key.cast("string")), (_each("o_orderkey", 307, 0), None)
        ).alias("session_id"),
        _case(
            F.concat(F.lit("TG-"), customer),
            (_each("o_orderkey", 211, 0), None),
            (_each("o_orderkey", 401, 7), F.concat(F.lit("TG-ghost-"), customer)),
        ).alias("pam_customer_id"),
        _case(
            F.date_format(login, ISO_SECONDS), (_each("o_orderkey", 101, 0), "not-a-time")
        ).alias("login_at"),
        _case(F.date_format(logout, ISO_SECONDS), (_each("o_orderkey", 409, 11), "")).alias(
            "logout_at"
        ),
        _case(
            F.lit("android"),
            (F.col("o_orderstatus") == "O", "web"),
            (F.col("o_orderstatus") == "F", "ios"),
        ).alias("device"),
        F.col("o_orderpriority").alias("ip_region"),
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class TableSources:
    """The four sources over one folder of tables, each made when first read."""

    def __init__(self, spark: SparkSession, folder: str):
        self._table = partial(table, spark, folder)

    @cached_property
    def pam_customers(self) -> DataFrame:
        return pam_customers(self._table("customer"), self._table("nation"))

    @cached_property
    def app_customers(self) -> DataFrame:
        return app_customers(self._table("customer"))

    @cached_property
    def activity_events(self) -> DataFrame:
        return activity_events(self._table("events"))

    @cached_property
    def customer_sessions(self) -> DataFrame:
        return customer_sessions(self._table("orders"))


def sources_from_tables(spark: SparkSession, folder: str) -> TableSources:
    return TableSources(spark, folder)
