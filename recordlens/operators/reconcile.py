"""Reconciliation of two sources that should describe the same records."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import week_start
from .spread import spread_join


def weekly_counts(
    left: DataFrame, right: DataFrame, date: str, names: tuple[str, str] = ("left_n", "right_n"),
    how: str = "inner",
) -> DataFrame:
    """Records per week on both sides, their difference and the right side's percentage.

    One aggregation counts both sides. ``inner`` shows weeks present on both; ``full`` also
    shows a week that one side lacks, which ``inner`` would hide.
    """
    a, b = names
    both = left.select(F.lit(0).alias("_side"), week_start(date).alias("week")).unionByName(
        right.select(F.lit(1).alias("_side"), week_start(date).alias("week"))
    )
    weeks = both.filter(F.col("week").isNotNull()).groupBy("week").agg(
        F.count_if(F.col("_side") == 0).alias(a), F.count_if(F.col("_side") == 1).alias(b)
    )
    if how == "inner":
        weeks = weeks.filter((F.col(a) > 0) & (F.col(b) > 0))
    pct = F.when(F.col(a) > 0, F.bround(F.col(b) * 100 / F.col(a), 1))
    return weeks.withColumns({"diff": F.col(b) - F.col(a), "pct": pct})


def weekly_summary(weeks: DataFrame, names: tuple[str, str] = ("left_n", "right_n")) -> DataFrame:
    """One row: totals, weeks outside the alarm limits, median, and the systematic-loss flag."""
    a, b = names
    return weeks.agg(
        F.count(F.lit(1)).alias("n_weeks"),
        F.sum(a).alias("left_total"),
        F.sum(b).alias("right_total"),
        F.bround(F.sum(b) * 100 / F.sum(a), 1).alias("total_pct"),
        F.count_if(F.col("pct") < V.COVERAGE_LOW_PCT).alias("weeks_low"),
        F.count_if(F.col("pct") > V.COVERAGE_HIGH_PCT).alias("weeks_high"),
        F.median("pct").alias("median_pct"),
    ).withColumn(
        "systematic",
        (F.col("n_weeks") > V.SYSTEMATIC_MIN_WEEKS)
        & (F.col("median_pct") < V.SYSTEMATIC_MEDIAN_PCT),
    )


def worst_weeks(weeks: DataFrame, k: int = 8) -> DataFrame:
    return weeks.orderBy(F.asc_nulls_last("pct"), "week").limit(k)


def self_validating_rows(independent: DataFrame, source: str, audited: str) -> DataFrame:
    """One row counting records of the audited source on the side meant to be independent."""
    n = F.count_if(F.col(source) == audited)
    return independent.agg(n.alias("n_audited"), (n == 0).alias("ok"))


def compare_named(
    ours: DataFrame, theirs: DataFrame, name: str, listed: DataFrame, value: str, flag: str,
    date: str,
) -> DataFrame:
    """Both sources' non-flagged count, mean and newest date for every listed name we hold.

    ``listed`` is one column of names; the join to it filters both sides.
    """
    names = listed.select(name).distinct()
    plain = ~F.col(flag)
    mine = (
        spread_join(ours, names, [name], "left_semi").groupBy(name).agg(
            F.count_if(plain).alias("our_n"),
            F.bround(F.avg(F.when(plain, F.col(value))), 2).alias("our_mean"),
            F.max(date).alias("our_latest"),
        )
    )
    other = (
        spread_join(theirs.filter(plain), names, [name], "left_semi").groupBy(name).agg(
            F.count(F.lit(1)).alias("their_n"),
            F.bround(F.avg(F.col(value)), 2).alias("their_mean"),
            F.max(date).alias("their_latest"),
        )
    )
    return mine.join(other, name, "left").withColumn(
        "newer", F.coalesce(F.col("their_latest") > F.col("our_latest"), F.lit(False))
    )


def positive_control(df: DataFrame, name: str, patterns: Sequence[str]) -> DataFrame:
    """Rows per control pattern. A control without rows makes every absence meaningless."""
    counts = df.agg(*[F.count_if(F.rlike(F.col(name), F.lit(p))).alias(f"n{i}")
                      for i, p in enumerate(patterns)])
    rows = F.array(*[
        F.struct(F.lit(p).alias("control"), F.col(f"n{i}").alias("n"),
                 (F.col(f"n{i}") > 0).alias("ok"))
        for i, p in enumerate(patterns)
    ])
    return counts.select(F.inline(rows))
