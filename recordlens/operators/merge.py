"""Loss-free union of record sources and attribute back-fill.

Joins here attach at most one row per key. A side is broadcast only when Spark has measured
it to be small; otherwise hot keys of the fact side are spread over many tasks.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .select import Order, dedupe_prefer
from .spread import spread_join


def reparent(df: DataFrame, key: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Replace retired ids by their live ones, in a single hop. ``old`` must be unique."""
    hop = mapping.select(F.col(old).alias(key), F.col(new).alias("_live"))
    joined = spread_join(df, hop, [key], "left").withColumn(key, F.coalesce("_live", key))
    return joined.select(*df.columns)


def chained_ids(mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Mappings whose target is itself retired; must be empty before a single hop is right."""
    retired = mapping.select(F.col(old).alias("_retired")).distinct()
    return mapping.join(retired, F.col(new) == F.col("_retired"), "left_semi")


def union_dedupe(
    sources: Sequence[tuple[str, DataFrame]],
    keys: Sequence[str],
    order_by: Order,
    source_col: str = "source",
) -> DataFrame:
    """Union by name; of rows equal on ``keys`` the one from the earliest source stays."""
    tagged = [
        df.withColumns({source_col: F.lit(name), "_priority": F.lit(i)})
        for i, (name, df) in enumerate(sources)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return dedupe_prefer(stacked, keys, ["_priority", *order_by]).drop("_priority")


def lost_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``before`` that ``after`` lacks, NULL parts compared as equal.

    One pass over both sides: a key is lost when no row of ``after`` carries it.
    """
    marked = before.select(*keys, F.lit(False).alias("_kept")).unionByName(
        after.select(*keys, F.lit(True).alias("_kept"))
    )
    seen = marked.groupBy(*keys).agg(F.max("_kept").alias("_after"))
    return seen.filter(~F.col("_after")).select(*keys)


def coalesce_attrs(
    primary: DataFrame, secondary: DataFrame, key: str, cols: Sequence[str]
) -> DataFrame:
    """Full outer join of two one-row-per-key tables, the primary's value winning per column."""
    p = primary.select(key, *[F.col(c).alias(f"_p_{c}") for c in cols])
    s = secondary.select(key, *[F.col(c).alias(f"_s_{c}") for c in cols])
    return p.join(s, key, "full").select(
        key, *[F.coalesce(f"_p_{c}", f"_s_{c}").alias(c) for c in cols]
    )


def annotate_missing(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    fill: dict[str, str],
    order_by: Order,
) -> DataFrame:
    """Fill NULLs of ``fill``'s columns from the lookup's first row per key.

    The lookup is reduced to one row per key first, so the row count cannot change.
    """
    one = dedupe_prefer(lookup, on, order_by).select(
        *on, *[F.col(src).alias(f"_fill_{dst}") for dst, src in fill.items()]
    )
    return (
        spread_join(df, one, on, "left")
        .withColumns({dst: F.coalesce(dst, f"_fill_{dst}") for dst in fill})
        .select(*df.columns)
    )


def merge_report(before: DataFrame, after: DataFrame, key: str, date: str) -> DataFrame:
    """One row: size and span of ``after`` and what it gained over ``before``."""
    sides = before.select(key, date, F.lit(0).alias("_after")).unionByName(
        after.select(key, date, F.lit(1).alias("_after"))
    )
    is_after = F.col("_after") == 1
    per_key = sides.groupBy(key).agg(
        F.count_if(is_after).alias("rows_after"),
        F.count_if(~is_after).alias("rows_before"),
        F.min(F.when(is_after, F.col(date))).alias("first_after"),
        F.max(F.when(is_after, F.col(date))).alias("last_after"),
        F.max(F.when(~is_after, F.col(date))).alias("last_before"),
    )
    return per_key.agg(
        F.sum("rows_after").alias("n_rows"),
        F.count_if(F.col("rows_after") > 0).alias("n_keys"),
        F.min("first_after").alias("first_date"),
        F.max("last_after").alias("last_date"),
        (F.sum("rows_after") - F.sum("rows_before")).alias("rows_gained"),
        F.datediff(F.max("last_after"), F.max("last_before")).alias("days_recovered"),
        F.count_if((F.col("rows_before") == 0)).alias("keys_gained"),
    )
