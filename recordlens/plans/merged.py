"""One inspection table out of the batch export and the portal."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import schemas as S
from ..functions.address import geocode_query
from ..functions.text import alnum_key
from ..operators.geocode import mark_cached
from ..operators.merge import annotate_missing, coalesce_attrs, reparent, union_dedupe
from ..operators.select import first_by
from ..operators.spread import spread_join
from .crosswalk import portal_attributes, scored_portal

ATTRS = ["restaurant_name", "address", "street", "city", "zip5"]
ROW = ["facility_id", "inspection_date", "score", "purpose", "inspection_type", "program_name",
       "permit_id", "inspection_id"]
OBSERVATION = ["facility_id", "inspection_date", "score"]


def merge_inspections(
    export: DataFrame, portal: DataFrame, crosswalk: DataFrame, merges: DataFrame
) -> DataFrame:
    """Every distinct observation of both sources once, in the canonical shape.

    The score is part of the key, so two visits on one day both survive; of equal
    observations the portal's row stays. Attributes come from the export where it has them,
    which keeps geocode keys stable. Free-text comments are never carried.
    """
    old = reparent(export, "facility_id", merges, "old_facility_id", "new_facility_id")
    ids = crosswalk.select("permitID", "facility_id")
    linked = spread_join(scored_portal(portal), ids, ["permitID"])

    new_rows = linked.select(
        "facility_id", F.col("date").alias("inspection_date"), "score", "purpose",
        F.col("inspectionType").alias("inspection_type"), F.col("programName").alias("program_name"),
        F.col("permitID").alias("permit_id"), F.col("inspectionID").alias("inspection_id"),
    )
    follow_up = F.col("is_followup")
    old_rows = old.select(
        *OBSERVATION, F.when(follow_up, V.FOLLOW_UP).when(~follow_up, V.ROUTINE).alias("purpose")
    )
    rows = union_dedupe(
        [(V.PORTAL_SOURCE, new_rows.filter("facility_id IS NOT NULL")),
         (V.BATCH_SOURCE, old_rows.filter("facility_id IS NOT NULL"))],
        OBSERVATION, ["inspection_id", "purpose"],
    )

    known = first_by(old, ["facility_id"], ATTRS, ["inspection_date", "score", *ATTRS])
    seen = first_by(portal_attributes(linked), ["facility_id"], ATTRS, ["date", "inspectionID"])
    attrs = coalesce_attrs(known, seen, "facility_id", ATTRS)
    out = spread_join(rows, attrs, ["facility_id"], "left").withColumns({
        "is_followup": F.col("purpose") == V.FOLLOW_UP, "_name": alnum_key("restaurant_name"),
    })

    types = portal.filter(F.col("score").isNotNull()).select(
        alnum_key("establishmentName").alias("_name"), F.col("date").alias("inspection_date"),
        "score", F.col("inspectionType").alias("_type"), F.col("programName").alias("_program"),
        "inspectionID",
    )
    filled = annotate_missing(
        out, types, ["_name", "inspection_date", "score"],
        {"inspection_type": "_type", "program_name": "_program"}, ["inspectionID"],
    )
    return filled.select(*S.INSPECTIONS.fieldNames())


def merged_counts(merged: DataFrame) -> DataFrame:
    """Rows per source and purpose."""
    return merged.groupBy("source", "purpose").agg(F.count(F.lit(1)).alias("n"))


def cached_share(merged: DataFrame, export: DataFrame, cache: DataFrame) -> DataFrame:
    """One row: geocode keys of facilities the export knew, how many are still resolved, and facilities it did not know.

    A merge that rewrites established addresses shows here as lost keys.
    """
    old = export.select("facility_id").distinct().withColumn("_old", F.lit(True))
    sites = merged.select("facility_id", "street", "city", "zip5", "address").distinct().withColumn(
        "query", geocode_query("street", "city", "zip5", "address"))
    marked = mark_cached(sites, cache).join(old, "facility_id", "left")
    known = F.col("_old").isNotNull()
    return marked.agg(
        F.count_if(known).alias("n_established"),
        F.count_if(known & F.col("mapped")).alias("n_cached"),
        F.count_distinct(F.when(~known, F.col("facility_id"))).alias("n_new_facilities"),
    ).withColumn("pct", F.bround(F.col("n_cached") * 100 / F.nullif("n_established", F.lit(0)), 1))
