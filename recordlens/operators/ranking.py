"""Entity score profiles and thresholded rankings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import recency_cutoff
from .select import asc, dedupe_prefer, desc

LOW_WORD = (1 << 32) - 1
INT_MAX = (1 << 31) - 1


def score_profile(df: DataFrame, key: str, score: str, date: str) -> DataFrame:
    """Count, mean, extremes, newest date and the score on it (the lowest on a tie).

    Date and inverted score share one long, so the pick is a plain ``max``: the whole profile
    stays a hash aggregate with map-side combine, however many rows one entity has. Scores are
    taken as whole numbers of 32 bits, negative ones too; a fraction is cut off.
    """
    df = df.withColumn(score, F.col(score).cast("int"))
    packed = F.shiftleft(F.unix_date(F.col(date)).cast("long"), 32) + (
        F.lit(INT_MAX).cast("long") - F.col(score)
    )
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bround(F.avg(score), 2).alias("mean_score"),
            F.min(score).alias("min_score"),
            F.max(score).alias("max_score"),
            F.max(date).alias("latest"),
            F.max(packed).alias("_packed"),
        )
        .withColumn(
            "latest_score",
            (F.lit(INT_MAX) - F.col("_packed").bitwiseAND(F.lit(LOW_WORD))).cast("int"),
        )
        .drop("_packed")
    )


def eligible(
    profile: DataFrame, records: DataFrame, date: str, min_n: int, months: int = V.RECENCY_MONTHS
) -> DataFrame:
    """Profiles with enough records whose newest one lies in the window of ``records``."""
    return profile.filter(
        (F.col("n") >= min_n) & (F.col("latest") >= recency_cutoff(records, date, months))
    )


def _ranking_order(direction: str, key: str) -> list[Column]:
    mean = desc("mean_score") if direction == "top" else asc("mean_score")
    return [mean, desc("n"), desc("latest"), asc(key)]


def rank_table(
    profile: DataFrame,
    direction: str,
    key: str,
    min_n: int,
    dedupe_by: Sequence[str],
    k: int = V.RANKING_ROWS,
) -> DataFrame:
    """The best or worst ``k`` entities, one slot per ``dedupe_by`` group, with their rank."""
    order = _ranking_order(direction, key)
    slots = dedupe_prefer(profile.filter(F.col("n") >= min_n), dedupe_by, order)
    # Only the k rows left after the distributed top-k reach the unpartitioned window.
    best = slots.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def rank_tables(
    profile: DataFrame, key: str, category: str, chosen: str, dedupe_by: Sequence[str],
    min_top: int = V.MIN_RECORDS_TOP, min_bottom: int = V.MIN_RECORDS_BOTTOM,
    k: int = V.RANKING_ROWS,
) -> DataFrame:
    """Four tables as one: {all, chosen category} x {top, bottom}.

    The category filter comes before the one-slot rule: filtering afterwards would lose a
    chosen entity whose slot was taken by one of another category.
    """
    # Each profile goes into the tables it belongs to, and all tables are ranked at once: the profile is
    # planned once, and map tasks keep k rows per table before the shuffle.
    enough = {"top": F.col("n") >= min_top, "bottom": F.col("n") >= min_bottom}
    scopes = {"all": F.lit(True), "chosen": F.col(category) == chosen}
    member = F.array_compact(F.array(*[
        F.when(inside & least, f"{scope}_{direction}")
        for scope, inside in scopes.items() for direction, least in enough.items()
    ]))
    rows = profile.withColumn("table", F.explode(member))
    mean = F.when(F.col("table").endswith("_top"), -F.col("mean_score")).otherwise(F.col("mean_score"))
    order = [mean.asc_nulls_last(), desc("n"), desc("latest"), asc(key)]
    slots = dedupe_prefer(rows, ["table", *dedupe_by], order)
    rank = F.row_number().over(Window.partitionBy("table").orderBy(*order))
    return slots.withColumn("rank", rank).filter(F.col("rank") <= k)
