"""Validation rules that are rows of a table, one set per tenant.

A rule names a source, a column, a kind and a bound:

| kind | a row breaks it if its value |
|---|---|
| `required` | is missing |
| `min`, `max` | is an exact decimal below, above the bound |
| `not_before`, `not_after` | is an ISO-8601 instant earlier, later than the bound |
| `matches` | does not match the bound, a regular expression, as a whole |
| `one_of` | is not among the bound's words, which a bar separates |
| `max_length` | has more characters than the bound |

A missing value breaks `required` only, and a value that is no number or no instant
breaks none of the rules that compare: the fixed rules judge those.  A tenant's rules
are tried by their position; the first one broken labels a row that carries no reason
yet.  Rows of tenants without rules stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinbridge.contracts import SOURCE_COLUMNS
from kinbridge.functions import exact_money, instant
from kinbridge.plans.validation import REASON

KINDS = (
    "required", "min", "max", "not_before", "not_after", "matches", "one_of", "max_length",
)


def _broken(rule: Column, values: Column) -> Column:
    """Whether a row with these values (by column) breaks one rule."""
    value, bound = F.element_at(values, rule["column"]), rule["bound"]
    number, limit = exact_money(value), rule["number"]
    at, moment = instant(value), rule["moment"]
    kind = rule["kind"]
    broken = (
        F.when(kind == "required", value.isNull())
        .when(kind == "min", number < limit)
        .when(kind == "max", number > limit)
        .when(kind == "not_before", at < moment)
        .when(kind == "not_after", at > moment)
        .when(kind == "matches", ~F.rlike(value, F.concat(F.lit("^(?:"), bound, F.lit(r")\z"))))
        .when(kind == "one_of", ~F.array_contains(rule["words"], value))
        .when(kind == "max_length", F.char_length(value) > limit)
    )
    return F.coalesce(broken, F.lit(False))


def checked(rules: DataFrame) -> DataFrame:
    """The rules; a row that no data could ever break or keep is an error, not ignored."""
    names = [f"{s}.{c}" for s, columns in SOURCE_COLUMNS.items() for c in columns]
    known = F.concat_ws(".", "source", "column").isin(names)
    numeric = F.col("kind").isin("min", "max", "max_length")
    timed = F.col("kind").isin("not_before", "not_after")
    usable = (
        F.when(numeric, exact_money("bound").isNotNull())
        .when(timed, instant("bound").isNotNull())
        .otherwise((F.col("kind") == "required") | F.col("bound").isNotNull())
    )
    wrong = rules.where(~(F.coalesce(known & F.col("kind").isin(*KINDS) & usable, F.lit(False))))
    text = F.to_json(F.struct(*rules.columns))
    first = wrong.agg(F.min(text).alias("rule")).first()["rule"]
    if first is not None:
        raise ValueError(f"unusable rule {first}")
    return rules


def by_tenant(rules: DataFrame, source: str) -> DataFrame:
    """(rule_tenant, rules): each tenant's rules of one source in order, bounds typed once."""
    rule = F.struct(
        "position",
        "reason",
        "column",
        "kind",
        "bound",
        exact_money("bound").alias("number"),
        instant("bound").alias("moment"),
        F.split("bound", r"\|").alias("words"),
    )
    return (
        rules.where(F.col("source") == source)
        .groupBy(F.col("tenant").alias("rule_tenant"))
        .agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    )


def apply(labelled: DataFrame, rules: DataFrame, source: str) -> DataFrame:
    """Labels rows that break a rule of their tenant, after all fixed rules.

    One join on the tenant, whatever the number of rules and tenants.  The rules are
    those of a manifest, one row per tenant after grouping; adaptive execution
    broadcasts them by their size, beyond which the join shuffles and splits a
    hot tenant.
    """
    values = F.create_map(
        *(part for c in SOURCE_COLUMNS[source] for part in (F.lit(c), F.col(c)))
    )
    joined = labelled.join(by_tenant(rules, source), F.col("tenant") == F.col("rule_tenant"), "left")
    broken = F.filter("rules", lambda rule: _broken(rule, values))
    first = F.try_element_at(broken, F.lit(1))["reason"]
    reason = F.when(F.col(REASON).isNull(), first).otherwise(F.col(REASON))
    return joined.withColumn(REASON, reason).drop("rule_tenant", "rules")
