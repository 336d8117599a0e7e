"""Deterministic one-row-per-key selection.

Row order carries no meaning in Spark, so every choice names a total order. The choice is a
``row_number() = 1`` filter: Spark then cuts each map task's rows down to one per key before
the shuffle, so a key holding a third of all rows still sends one row per task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def _order(order_by: Order) -> list[Column]:
    return [asc(o) if isinstance(o, str) else o for o in order_by]


def dedupe_prefer(df: DataFrame, keys: Sequence[str], order_by: Order) -> DataFrame:
    """The first row of every key under ``order_by``, which must order each key totally."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order_by)))
    return df.withColumn("_pick", ranked).filter(F.col("_pick") == 1).drop("_pick")


def first_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order_by: Order) -> DataFrame:
    """``cols`` of the first row of every key; a NULL in that row stays NULL."""
    return dedupe_prefer(df, keys, order_by).select(*keys, *cols)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    prefer: Order,
    where: Column | None = None,
) -> DataFrame:
    """Newest row per key; ``where`` is applied before choosing, never after."""
    kept = df if where is None else df.filter(where)
    return dedupe_prefer(kept, keys, [desc(date), *prefer])


def newest_version(df: DataFrame, keys: Sequence[str], stamp: str, order_by: Order) -> DataFrame:
    """Newest ingested version of every record."""
    return dedupe_prefer(df, keys, [desc(stamp), *order_by])


def entity_profile(
    df: DataFrame, key: str, attrs: dict[str, str], date: str, order_by: Sequence[str]
) -> DataFrame:
    """First attributes, first and last date and row count of every entity, in one pass.

    ``attrs`` maps output names to columns. All aggregates combine on the map side. What orders the rows and is
    an attribute as well stands once in what is shuffled; where ``order_by`` leaves a tie, the smallest attributes stay.
    """
    order = [part for o in order_by for part in (F.col(o).isNull().alias(f"_no_{o}"), F.col(o).alias(o))]
    others = [F.col(c) for c in dict.fromkeys(attrs.values()) if c not in order_by]
    first = F.min(F.struct(*order, *others))
    grouped = df.groupBy(key).agg(
        first.alias("_first"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    chosen = [F.col("_first").getField(c).alias(n) for n, c in attrs.items()]
    return grouped.select(key, *chosen, "first_date", "last_date", "n_rows")


def same_date_conflicts(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Keys with several values on their newest date: ``values`` as (value, n) in order, and as text.

    Copies are counted before anything is gathered, so a group holds one entry per distinct value. The
    text has one form for every size: each value, with " xN" behind it where it occurs N > 1 times.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, date, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    newest = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(date).desc_nulls_last()))
    grouped = (
        counted.withColumn("_rank", newest)
        .filter("_rank = 1")
        .groupBy(*keys)
        .agg(
            F.first(date).alias(date),
            F.sum("_n").alias("n_rows"),
            F.count(F.lit(1)).alias("_distinct"),
            F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").alias("n"))))
            .alias("_values"),
        )
        .filter("n_rows > 1")
    )
    text = F.array_join(F.transform("_values", lambda s: F.when(
        s["n"] > 1, F.concat(s["v"].cast("string"), F.lit(" x"), s["n"].cast("string"))
    ).otherwise(s["v"].cast("string"))), " / ")
    values = F.transform("_values", lambda s: F.struct(s["v"].alias("value"), s["n"].alias("n")))
    return grouped.select(
        *keys, date, "n_rows", values.alias("values"), text.alias("values_text"),
        (F.col("_distinct") > 1).alias("disagree"),
    )
