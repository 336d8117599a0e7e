"""Calendar rules."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _c


def week_start(day: Column | str) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(F.next_day(_c(day), "SUN"), 7)


def ap_date(day: Column | str) -> Column:
    day = _c(day)
    months = F.array(*[F.lit(m) for m in V.AP_MONTHS])
    return F.concat(
        F.element_at(months, F.month(day)), F.lit(" "), F.day(day).cast("string"),
        F.lit(", "), F.year(day).cast("string"),
    )


def long_date(day: Column | str) -> Column:
    return F.date_format(_c(day), "MMMM d, yyyy")


def portal_date(text: Column | str) -> Column:
    """Calendar day of a timestamp held as text."""
    return F.substring(_c(text), 1, 10).try_cast("date")


def data_through(df: DataFrame, date: str) -> Column:
    """Newest date of ``df`` as a scalar subquery, so the anchor stays inside the plan."""
    return df.agg(F.max(date)).scalar()


def recency_cutoff(df: DataFrame, date: str, months: int = V.RECENCY_MONTHS) -> Column:
    """Start of the recency window, anchored to the data and never to the clock."""
    return F.add_months(data_through(df, date), -months)
