"""Permit-to-facility crosswalk, its id merges and its review queue."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import schemas as S
from ..functions.address import clean_city
from ..functions.classify import categorize
from ..functions.dates import data_through
from ..functions.text import house_num, loose_name, norm_name, norm_street
from ..operators import resolve as R
from ..operators.select import entity_profile
from ..operators.spread import spread_join
from ..session import materialise

A, B = "permitID", "facility_id"


@dataclass(frozen=True)
class Crosswalk:
    crosswalk: DataFrame   # one row per permit
    merges: DataFrame      # retired facility id -> live facility id
    review: DataFrame      # what a person has to decide
    candidates: DataFrame  # block -> facility ids, for the review queue's ambiguous blocks


def scored_portal(portal: DataFrame) -> DataFrame:
    return portal.filter(F.col("inspectionType") == V.SCORED_TYPE)


def _keys(df: DataFrame, name: str, street: str) -> DataFrame:
    return df.withColumns({
        "k_name": norm_name(name), "k_street": norm_street(street), "k_num": house_num(street),
        "k_loose": loose_name(name),
    })


def permit_profile(portal: DataFrame) -> DataFrame:
    """One row per permit of the scored type, with its match keys."""
    profile = entity_profile(
        scored_portal(portal), A,
        {"p_name_raw": "establishmentName", "p_addr_raw": "addressLine1", "p_city": "city",
         "_zip": "zip"},
        "date", ["date", "inspectionID"],
    )
    return _keys(
        profile.select(A, "p_name_raw", "p_addr_raw", "p_city",
                       F.substring("_zip", 1, 5).alias("p_zip"),
                       F.substring("_zip", 1, 5).alias("zip"),
                       F.col("first_date").alias("p_first"), F.col("last_date").alias("p_last"),
                       F.col("n_rows").alias("p_n")),
        "p_name_raw", "p_addr_raw",
    )


def facility_profile(ins: DataFrame) -> DataFrame:
    """One row per facility with its span and match keys."""
    profile = entity_profile(
        ins, B,
        {"i_name_raw": "restaurant_name", "i_addr_raw": "street", "i_city": "city", "zip": "zip5"},
        "inspection_date", ["inspection_date", "score", "restaurant_name", "street", "zip5"],
    )
    return _keys(
        profile.withColumnsRenamed({"first_date": "i_first", "last_date": "i_last", "n_rows": "i_n"}),
        "i_name_raw", "i_addr_raw",
    )


def observation_events(portal: DataFrame, ins: DataFrame) -> R.Events:
    permits = scored_portal(portal).filter(F.col("score").isNotNull())
    facilities = ins.filter(F.col("score").isNotNull())
    return R.Events(
        permits.select(A, F.col("date").alias("day"), "score").distinct(),
        facilities.select(B, F.col("inspection_date").alias("day"), "score").distinct(),
        ("day", "score"),
    )


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), parts)


def build_crosswalk(
    portal: DataFrame, ins: DataFrame, stage: Callable[[DataFrame], DataFrame] = materialise
) -> Crosswalk:
    """Resolve permits to facilities.

    ``ins`` must be the batch export alone: feeding the merged table back would let the
    resolver match its own synthetic ids. ``stage`` writes the intermediates several branches
    read; by default they go to the reliable checkpoint folder.
    """
    permits = stage(permit_profile(portal))
    facilities = stage(facility_profile(ins))
    opened = scored_portal(portal).agg(F.min("date")).scalar()
    active = facilities.filter(F.col("i_last") >= opened)
    seen = observation_events(portal, ins)
    events = R.Events(stage(seen.a), stage(seen.b), seen.on)

    tiers = R.tier_match(permits, active, A, B, V.MATCH_TIERS, events, stage=stage)
    by_key = tiers.matched
    unresolved = stage(tiers.unresolved)

    left = permits.join(by_key.select(A), A, "left_anti")
    by_name = stage(R.corroborated_match(
        left.withColumnRenamed("k_loose", "a_loose"),
        active.withColumnRenamed("k_loose", "b_loose"),
        A, B, ("k_street", "zip"), "a_loose", "b_loose", events, stage=stage,
    ))
    unresolved = unresolved.join(by_name.select(A), A, "left_anti")

    loosest = F.col("tier") == V.MATCH_TIERS[-1][0]
    handed, merges = R.handoff_merge(
        unresolved.filter(loosest), tiers.members.filter(loosest), permits, facilities,
        A, B, "k_num", "p_name_raw", "i_first", "i_last", stage=stage,
    )
    unresolved = unresolved.join(handed.select(A), A, "left_anti")

    checked = stage(R.guard_check(_union(by_key, by_name, handed), permits, facilities, A, B, "k_num"))
    matched, demoted, merges = R.guard_demote(checked, merges, A, B)
    unmatched = stage(
        R.unmatched_status(permits, matched, A, B, "p_first", data_through(ins, "inspection_date"))
    )

    shown_p, shown_i = ["p_name_raw", "p_addr_raw", "p_city", "p_zip"], ["i_name_raw", "i_addr_raw"]
    null = F.lit(None).cast("string")
    crosswalk = _union(
        spread_join(matched.join(permits.select(A, *shown_p), A, "left"),
                    facilities.select(B, *shown_i), [B], "left")
        .withColumn("status", F.lit("matched"))
        .select(*S.CROSSWALK.fieldNames()),
        unmatched.select(
            A, B, null.alias("match_method"), null.alias("confidence"),
            F.lit(None).cast("int").alias("n_shared_events"), *shown_p,
            null.alias("i_name_raw"), null.alias("i_addr_raw"), "status"),
    )

    routine = (
        scored_portal(portal).filter(F.col("purpose") == V.ROUTINE).groupBy(A)
        .agg(F.count(F.lit(1)).cast("int").alias("n_routine"),
             F.bround(F.avg("score"), 1).alias("mean_score"))
    )
    stats = permits.select(A, "p_name_raw", "p_addr_raw", "p_zip", "p_first", "p_last").join(
        routine, A, "left"
    ).withColumns({
        "n_routine": F.coalesce("n_routine", F.lit(0)), "category": categorize("p_name_raw"),
    })
    triage = (
        (F.col("n_routine") >= V.TRIAGE_MIN_RECORDS)
        & (F.col("mean_score") < V.TRIAGE_MAX_MEAN)
        & (F.col("category") == V.RESTAURANT)
    )
    review = R.review_queue(unresolved, demoted, unmatched, stats, A, B, triage)
    renamed = merges.select(
        F.col("old_id").alias("old_facility_id"), F.col("new_id").alias("new_facility_id"),
        "business", "gap_days",
    )
    return Crosswalk(crosswalk, renamed, review, tiers.members)


def portal_attributes(portal: DataFrame) -> DataFrame:
    """Attributes of portal facilities, for those the export does not know."""
    return portal.select(
        B, F.col("establishmentName").alias("restaurant_name"),
        F.col("addressLine1").alias("address"), F.col("addressLine1").alias("street"),
        clean_city("city").alias("city"), F.substring("zip", 1, 5).alias("zip5"),
        "date", "inspectionID",
    )
