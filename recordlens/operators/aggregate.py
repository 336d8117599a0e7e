"""Counts, rates, extents and reports. All combine on the map side."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.classify import band


def extent(df: DataFrame, date: str, key: str) -> DataFrame:
    """One row: first and last date, rows and distinct keys."""
    return df.agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
    )


def frequency(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *by)


def duplicates(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in cols])
    return counts.select(F.inline(pairs))


def band_counts(
    df: DataFrame,
    value: str,
    breaks: Sequence[float] = tuple(b[4] for b in V.BANDS[:-1]),
    labels: Sequence[str] = tuple(b[0] for b in V.BANDS),
) -> DataFrame:
    """Rows per band in fixed band order; an empty band counts zero."""
    return facet_counts(df.withColumn("_band", band(value, breaks, labels)), "_band", labels)


def facet_counts(
    df: DataFrame, facet: str, labels: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Rows per facet label under a filter on the other facets, zero-filled, in label order."""
    kept = df if where is None else df.filter(where)
    counts = kept.agg(*[F.count_if(F.col(facet) == label).alias(f"n{i}")
                        for i, label in enumerate(labels)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("band"), F.col(f"n{i}").alias("n"))
        for i, label in enumerate(labels)
    ])
    return counts.select(F.inline(rows))


def three_band_counts(df: DataFrame, group: Column) -> DataFrame:
    return df.groupBy(group.alias("score_group")).agg(F.count(F.lit(1)).alias("n"))


def conditional_stats(
    df: DataFrame, by: Sequence[str], value: str, flag: str, date: str, decimals: int = 2
) -> DataFrame:
    """Rows and mean of ``value`` where ``flag`` is false, and the newest date of all rows."""
    plain = ~F.col(flag)
    return df.groupBy(*by).agg(
        F.count_if(plain).alias("n_plain"),
        F.bround(F.avg(F.when(plain, F.col(value))), decimals).alias("mean_plain"),
        F.max(date).alias("latest"),
    )


def coverage(df: DataFrame, hit: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, hits and hit percentage, in total or per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(hit)).alias("n_hit"),
        F.bround(F.avg(F.coalesce(F.col(hit), F.lit(False)).cast("int")) * 100, 1).alias("pct"),
    )


def stack_stats(df: DataFrame, size: str = "stack_n") -> DataFrame:
    return df.agg(
        F.count_if(F.col(size) > 1).alias("n_stacked"), F.max(size).alias("largest_stack")
    )
