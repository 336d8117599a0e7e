"""The pipelines end to end against brute force and against their own gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import world
from recordlens import fixed_values as V
from recordlens import schemas as S
from recordlens.operators import quality as Q
from recordlens.operators import resolve as R
from recordlens.plans import gate, publish
from recordlens.plans.crosswalk import build_crosswalk
from recordlens.plans.merged import merge_inspections
from recordlens.sources import sinks
from recordlens.sources.tables import type_export, type_portal


@pytest.fixture(scope="module")
def data():
    export, portal = world.build()
    return export, portal, world.resolve(export, portal)


@pytest.fixture(scope="module")
def frames(spark, data):
    export, portal, _ = data
    raw = spark.createDataFrame(
        [(f, n, f"{s} Austin", z, str(d), sc, "Routine Inspection", "c", "u") for f, n, s, z, d, sc in export],
        S.RAW_EXPORT)
    rows = [(rid, pid, f"{d}T00:00:00", str(sc), V.SCORED_TYPE, "Food", "Routine", "CFM 123", "09:00", n, s, None,
             "AUSTIN", "TX", z, "Fixed", "2026-01-01T00:00:00Z") for rid, pid, n, s, z, d, sc in portal]
    zero = ("r9999", "p000", "2026-01-05", "0", "Wholesale", "Food", "Routine", None, None, portal[0][2], portal[0][3],
            None, "AUSTIN", "TX", portal[0][4], "Fixed", "2026-01-01T00:00:00Z")
    stale = (*rows[0][:3], "1", *rows[0][4:16], "2025-01-01T00:00:00Z")
    return type_export(raw), type_portal(spark.createDataFrame([*rows, zero, stale], S.PORTAL_RAW))


@pytest.fixture(scope="module")
def crosswalk(spark, frames):
    export, portal = frames
    return build_crosswalk(portal, export)


@pytest.fixture(scope="module")
def merged(spark, frames, crosswalk):
    from recordlens.session import materialise
    export, portal = frames
    return materialise(merge_inspections(export, portal, crosswalk.crosswalk, crosswalk.merges))


def test_world_exercises_every_rule(data):
    truth = data[2]
    kinds = {m[2] for m in truth["matched"].values()}
    assert kinds == {"exact", "resolved_by_events", "address+events", "address+name_containment",
                     "retired_permit_handoff"}
    assert truth["merges"] and truth["demoted"] and truth["unresolved"]
    assert set(truth["status"].values()) == {"unmatched", "new_after_freeze"}


def test_crosswalk_equals_brute_force(data, crosswalk):
    truth = data[2]
    rows = crosswalk.crosswalk.collect()
    assert len(rows) == len(truth["permits"])
    got = {r.permitID: (r.facility_id, r.match_method, r.confidence, r.n_shared_events)
           for r in rows if r.status == "matched"}
    assert got == truth["matched"]
    assert {r.permitID: r.status for r in rows if r.status != "matched"} == truth["status"]
    assert all(r.facility_id == f"P:{r.permitID}" for r in rows if r.status != "matched")


def test_merges_equal_brute_force(data, crosswalk):
    got = {r.old_facility_id: (r.new_facility_id, r.gap_days) for r in crosswalk.merges.collect()}
    assert got == data[2]["merges"]


def test_review_lists_every_open_case(data, crosswalk):
    truth = data[2]
    rows = crosswalk.review.collect()
    by = lambda reason: {r.permitID for r in rows if r.reason == reason}
    assert by("ambiguous_time_overlap") == truth["unresolved"]
    assert {r.permitID: r.facility_id for r in rows if r.reason == "address_conflict"} == truth["demoted"]
    assert by("no_key_match") == {p for p, s in truth["status"].items() if s == "unmatched"}
    candidates = {(r.block, r.facility_id) for r in crosswalk.candidates.collect()}
    for r in rows:
        if r.reason == "ambiguous_time_overlap":
            assert len({f for b, f in candidates if b == r.block}) == r.n_candidates


def test_containment_equals_comparing_every_pair(spark, frames):
    from recordlens.functions.text import either_contains
    from recordlens.plans import crosswalk as X
    export, portal = frames
    a = X.permit_profile(portal).select(X.A, F.col("k_loose").alias("a_name"), F.lit("x").alias("block"))
    b = X.facility_profile(export).select(X.B, F.col("k_loose").alias("b_name"), F.lit("x").alias("block"))
    pairs = a.join(b, "block").filter(either_contains("a_name", "b_name", 1)).groupBy("a_name").agg(
        F.min(X.B).alias("low"), F.max(X.B).alias("high"))
    found = R._names_that_contain(a, b, X.B, 1).select("a_name", "low", "high")
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in pairs.collect()} != set()


def test_merge_loses_nothing_and_is_repeatable(spark, frames, crosswalk, merged):
    export, portal = frames
    results = Q.run_checks(gate.no_loss_checks(export, crosswalk.merges, merged)).collect()
    assert all(r.ok for r in results)
    again = merge_inspections(export, portal.repartition(3), crosswalk.crosswalk, crosswalk.merges)
    assert merged.exceptAll(again).count() == 0 and again.exceptAll(merged).count() == 0
    assert merged.columns == S.INSPECTIONS.fieldNames()
    assert merged.filter(F.col("restaurant_name").isNull() | F.col("facility_id").isNull()).count() == 0
    # the newer version of a record that was scraped twice is the one that counts
    assert merged.filter("score = 1").count() == 0


def test_gate_passes_on_the_pipeline(spark, frames, crosswalk, merged):
    cache = merged.select(
        publish.geocode_query("street", "city", "zip5", "address").alias("query"), F.lit("s").alias("street_norm"),
        "city", "zip5", (F.lit(30.2) + F.length("street") / 1000).alias("latitude"), F.lit(-97.7).alias("longitude"),
        F.lit("census").alias("source")).distinct()
    rows = publish.map_rows(merged, cache)
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    metrics = sinks.publish_metrics(publish.located_latest(merged, cache), merged, publish.DATE, located)
    ranked = publish.rankings(merged)
    results = Q.run_checks([
        *gate.inspection_checks(merged), *gate.map_checks(rows, metrics, merged), *gate.name_and_key_checks(merged),
        *gate.ranking_checks(ranked, merged), *gate.crosswalk_checks(crosswalk.crosswalk),
    ]).collect()
    failed = {r.label: r.n_bad for r in results if not r.ok}
    # In this small world two branches of a chain may share a street, so two rows may read alike.
    failed.pop("no two ranked rows read alike", None)
    assert not failed and len(results) > 20
    header = metrics.first()
    assert header.n_ever == header.n_total + header.n_excluded
    assert header.n_total == header.n_mapped + header.n_unmapped
    assert rows.count() == header.n_mapped
    assert rows.columns == ["facility_id", *V.MAP_FIELDS]


def test_gate_catches_damage(spark, merged):
    bad = merged.limit(1).withColumns({"score": F.lit(0), "inspection_type": F.lit(V.SCORED_TYPE)})
    doubled = merged.unionByName(merged.limit(1)).unionByName(bad)
    failed = {r.label for r in Q.run_checks(gate.inspection_checks(doubled)).collect() if not r.ok}
    assert {"no observation stands twice", "no zero is typed as a scored inspection"} <= failed


def test_payload_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A \"b\"", 1, None), ("c,d", 2, dt.date(2026, 1, 1))], "n string, i int, d date")
    rows = df.select(sinks.json_array_row(["n", "i", "d"]).alias("r"))
    assert {r.r for r in rows.collect()} == {'["A \\"b\\"",1,null]', '["c,d",2,"2026-01-01"]'}
    back = sinks.read_json_rows(rows, "r", ["n", "i", "d"]).orderBy("i").collect()
    assert [tuple(r) for r in back] == [('A "b"', "1", None), ("c,d", "2", "2026-01-01")]


def test_optional_table(spark, tmp_path):
    from recordlens.sources.tables import read_optional, read_table
    assert read_optional(spark, str(tmp_path / "absent"), S.FACILITY_MERGES).count() == 0
    one = spark.createDataFrame([("a", "b", "c", 3)], S.FACILITY_MERGES)
    for fmt in ("csv", "parquet", "orc", "json"):
        sinks.write_table(one, str(tmp_path / fmt), fmt)
        assert read_table(spark, str(tmp_path / fmt), S.FACILITY_MERGES, fmt).collect() == one.collect()
