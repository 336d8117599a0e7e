"""Joins and positions that stay balanced when one key or group is huge."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def spread_join(facts: DataFrame, dims: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` to ``dims`` so that hot keys of ``facts`` can be split.

    AQE splits a skewed join by the (compressed) bytes that were shuffled, whatever the rows and however many
    keys are hot, but only when both inputs come straight from a shuffle for this join. That is not so when ``dims`` was
    aggregated or deduplicated on the join key. A hash of the key as one more join column makes the planner
    shuffle both sides anew. Each side is evaluated once, so chains of joins stay linear. Rows with a NULL
    key match nothing and are split like others.
    """
    on = list(on)
    digest = F.xxhash64(*on)
    joined = facts.withColumn("_digest", digest).join(dims.withColumn("_digest", digest), [*on, "_digest"], how)
    return joined.drop("_digest")


def group_index(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    index: str = "i",
    size: str = "stack_n",
) -> DataFrame:
    """Zero-based position of every row in its group, and the group's size.

    A plain window would put one group into one task. Here the rows are range-partitioned on
    (keys, order), which cuts a big group into several ranges. Each range is numbered on its
    own, and the number of rows in earlier ranges of the same group is added. The ranges are
    materialised first, because both branches must see the same cut. Keys must not be NULL.
    """
    cut = materialise(
        df.repartitionByRange(*keys, *order_by).withColumn("_range", F.spark_partition_id())
    )
    by_range = Window.partitionBy(*keys).orderBy("_range")
    offsets = (
        cut.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn(size, F.sum("_n").over(Window.partitionBy(*keys)))
        .drop("_n")
    )
    local = F.row_number().over(
        Window.partitionBy("_range", *keys).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    )
    return (
        cut.withColumn("_local", local)
        .join(offsets, [*keys, "_range"])
        .withColumn(index, F.col("_before") + F.col("_local") - 1)
        .drop("_local", "_before", "_range")
    )


def dictionary(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Distinct values of ``col`` with their zero-based position in binary order."""
    levels = df.filter(F.col(col).isNotNull()).select(col).distinct()
    # One constant group: every level is numbered, without one task seeing them all.
    return group_index(levels.withColumn("_all", F.lit(1)), ["_all"], [col], code, "_size").drop(
        "_all", "_size"
    )


def encode_dictionary(df: DataFrame, col: str, code: str) -> DataFrame:
    """Add the dictionary code of ``col`` (NULL for NULL)."""
    return spread_join(df, dictionary(df, col, code), [col], "left")


def by_distinct(df: DataFrame, col: str, out: str, rule: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``rule`` of ``col`` as ``out``, worked out once per distinct value and joined back, also to a hot value.

    Worth it where values repeat and the rule is dear, as a cascade of patterns is.
    """
    coded = df.filter(F.col(col).isNotNull()).select(col).distinct().select(col, rule(F.col(col)).alias("_coded"))
    joined = spread_join(df, coded, [col], "left")
    nothing = rule(F.lit(None).cast("string"))
    return joined.select(*df.columns, F.when(F.col(col).isNull(), nothing).otherwise(F.col("_coded")).alias(out))
