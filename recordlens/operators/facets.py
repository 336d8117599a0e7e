"""Facet filter and text search over published rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import haystack


def facet_filter(facet: str, chosen: str | None) -> Column:
    """Rows of the chosen facet value; ``None`` stands for all."""
    return F.lit(True) if chosen is None else F.col(facet) == chosen


def visible_total(counts: DataFrame, enabled: Sequence[str]) -> DataFrame:
    """Sum over the enabled bands. Switching a band changes this, not the counts."""
    return counts.agg(F.sum(F.when(F.col("band").isin(*enabled), F.col("n")).otherwise(0)).alias("visible"))


def search(
    df: DataFrame, fields: Sequence[str], text: str, order_by: Sequence[Column | str],
    min_chars: int = V.SEARCH_MIN_CHARS, k: int = V.SEARCH_HITS,
) -> DataFrame:
    """The first ``k`` rows in ``order_by`` whose fields contain ``text``, ignoring case."""
    wanted = text.strip().lower()
    if len(wanted) < min_chars:
        return df.filter(F.lit(False))
    return df.filter(F.contains(haystack(*fields), F.lit(wanted))).orderBy(*order_by).limit(k)
