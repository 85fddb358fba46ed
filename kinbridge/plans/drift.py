"""Drift of a measure's values, from stored quantile sketches.

A load stores one KLL sketch per tenant and day.  Sketches merge, so a day is compared
with the days before it without reading facts again.  The comparison is by rank: without
drift a day's median lies near the median of the days before, here between their
quantiles of 0.4 and 0.6.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch and the error of its ranks: 2.3 / k to the power of 0.9 covers 99 % of
#: single queries, and twice that also covers merged sketches and many queries at once.
#: Days of up to ``SKETCH_K`` values are kept exactly.
SKETCH_K, RANK_ERROR = 1024, 0.01
#: Quantiles that are compared, and how far the rank of one may move.
QUANTILES = (0.25, 0.5, 0.75)
TOLERANCE = 0.1
#: Days before, and the values that they must hold at least.
WINDOW_DAYS, LEAST_VALUES = 7, 50


def value_sketches(facts: DataFrame, day: str, measure: Column | str) -> DataFrame:
    """(tenant, day, sketch) to be stored with a load; sketches of any loads merge.

    One sketch per task, tenant and day is shuffled, so a hot tenant sends no rows.
    """
    value = (F.col(measure) if isinstance(measure, str) else measure).cast("double")
    given = facts.select("tenant", F.col(day).alias("day"), value.alias("value"))
    return given.where(F.col("value").isNotNull()).groupBy("tenant", "day").agg(
        F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch")
    )


def _merged(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("tenant", "day").agg(
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch")
    )


def with_past(sketches: DataFrame) -> DataFrame:
    """(tenant, day, sketch, past): each day with the merged days before it.

    Every day is dealt to itself and to the days whose past it belongs to, a fixed number
    of copies, and both are merged by one shuffle.  A join would broadcast one side, whose
    size on disk says little of that of its sketches in the driver.  Days without any past
    are left out, as are those that only have a past.
    """
    ago, mine = F.col("ago"), F.col("ago") == 0
    days = F.explode(F.sequence(F.lit(0), F.lit(WINDOW_DAYS)))
    dealt = (
        _merged(sketches)
        .where("tenant IS NOT NULL AND day IS NOT NULL")
        .select("tenant", "day", "sketch", days.alias("ago"))
        .select("tenant", F.date_add("day", ago).alias("day"), "ago", "sketch")
    )
    past = F.kll_merge_agg_double(F.when(~mine, F.col("sketch")), F.lit(SKETCH_K))
    return (
        dealt.groupBy("tenant", "day")
        .agg(
            F.max(F.when(mine, F.col("sketch"))).alias("sketch"),
            # An empty sketch has no quantiles, and filters may be evaluated in any order.
            F.when(F.count_if(~mine) > 0, past).alias("past"),
        )
        .where("sketch IS NOT NULL AND past IS NOT NULL")
    )


def quantile_bands(sketches: DataFrame) -> DataFrame:
    """(tenant, day, n, past_n, q, value, low, high): each quantile of a day, and where the
    days before it would have it."""

    def of(sketch: str, moved: float) -> Column:
        ranks = F.array(*(F.lit(round(q + moved, 6)) for q in QUANTILES))
        return F.kll_sketch_get_quantile_double(sketch, ranks)

    found = with_past(sketches).select(
        "tenant",
        "day",
        F.kll_sketch_get_n_double("sketch").alias("n"),
        F.kll_sketch_get_n_double("past").alias("past_n"),
        F.arrays_zip(
            F.array(*map(F.lit, QUANTILES)).alias("q"),
            of("sketch", 0).alias("value"),
            of("past", -TOLERANCE).alias("low"),
            of("past", TOLERANCE).alias("high"),
        ).alias("bands"),
    )
    return found.select("tenant", "day", "n", "past_n", F.inline("bands"))


def drifted_days(sketches: DataFrame) -> DataFrame:
    """(tenant, day, n, past_n, drifted): whether any quantile leaves its band.

    A day is only judged if it and its past hold enough values, otherwise ``drifted`` is NULL.
    """
    enough = (F.col("n") >= LEAST_VALUES) & (F.col("past_n") >= LEAST_VALUES)
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return (
        quantile_bands(sketches)
        .groupBy("tenant", "day", "n", "past_n")
        .agg(F.bool_or(outside).alias("outside"))
        .select("tenant", "day", "n", "past_n", F.when(enough, F.col("outside")).alias("drifted"))
    )
