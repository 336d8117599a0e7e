"""Completeness of the portal, measured against the batch export alone."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import data_through
from ..operators.reconcile import weekly_counts

SIDES = ("export_n", "portal_n")


def weekly_reconciliation(
    export: DataFrame, portal: DataFrame, not_before: str = V.OVERLAP_NOT_BEFORE,
    purposes: Sequence[str] = (V.ROUTINE, V.FOLLOW_UP),
) -> DataFrame:
    """Records per week on both sides, within the days and the kinds of visit that both sides hold.

    Only the food program and the purposes the export knows are counted on the portal's side. The range starts
    with the portal's first food record, but not before ``not_before``, and ends with the export's newest one.
    """
    food = portal.filter(F.col("programName") == V.FOOD_PROGRAM)
    start = F.greatest(food.agg(F.min("date")).scalar(), F.lit(not_before).cast("date"))
    shared = F.col("day").between(start, data_through(export, "inspection_date"))
    return weekly_counts(
        export.select(F.col("inspection_date").alias("day")).filter(shared),
        food.filter(F.col("purpose").isin(*purposes)).select(F.col("date").alias("day")).filter(shared),
        "day", SIDES,
    )
