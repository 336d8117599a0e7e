"""Multi-row cases, order independence, and groups of every size."""

import datetime as dt
import random

from pyspark.sql import functions as F

from recordlens.operators import aggregate as AG
from recordlens.operators import facets as FA
from recordlens.operators import fetch as FE
from recordlens.operators import geocode as G
from recordlens.operators import merge as M
from recordlens.operators import quality as Q
from recordlens.operators import ranking as RK
from recordlens.operators import reconcile as RC
from recordlens.operators import select as S
from recordlens.operators import spread as SP

DAY = dt.date(2026, 3, 3)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_latest_filters_before_choosing(spark):
    data = [("F", dt.date(2025, 5, 8), 98, 1), ("F", dt.date(2025, 9, 1), 0, 2),
            ("S", DAY, 100, 3), ("S", DAY, 87, 4), ("N", DAY, 0, 5)]
    df = spark.createDataFrame(data, "k string, d date, s int, id int")
    got = rows_of(S.latest_per_key(df, ["k"], "d", ["s", "id"], F.col("s") > 0), "k")
    assert got == [data[0], data[3]]


def test_selection_does_not_depend_on_row_order(spark):
    rng = random.Random(3)
    data = [(rng.randrange(5), dt.date(2020, 1, 1 + rng.randrange(5)), rng.randrange(3), i) for i in range(200)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, d date, s int, id int").repartition(seed + 1)
        results.add(tuple(rows_of(S.latest_per_key(df, ["k"], "d", ["s", "id"]), "k")))
    assert len(results) == 1


def test_profile_keeps_a_null_first_value(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", None, "z"), ("b", 3, "y")],
                               "k string, o int, v string")
    got = rows_of(S.entity_profile(df, "k", {"v": "v"}, "o", ["o"]), "k")
    assert got == [("a", None, 1, 2, 2), ("b", "y", 3, 3, 2)]


def test_conflicts(spark):
    data = [("a", DAY, 100), ("a", DAY, 87), ("a", dt.date(2020, 1, 1), 5), ("b", DAY, 90), ("b", DAY, 90),
            ("c", DAY, 1), ("d", DAY, None), ("d", DAY, 3), ("a", DAY, 9)]
    df = spark.createDataFrame(data, "k string, d date, s int")
    assert rows_of(S.same_date_conflicts(df, ["k"], "d", "s"), "k") == [
        ("a", DAY, 3, [(9, 1), (87, 1), (100, 1)], "9 / 87 / 100", True), ("b", DAY, 2, [(90, 2)], "90 x2", False)]


def test_group_index_in_one_huge_group(spark):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, 0).otherwise(F.col("id") % 7).alias("k"),
                                   (F.lit(20000) - F.col("id")).alias("o"))
    got = SP.group_index(df, ["k"], ["o"])
    expected = df.selectExpr("k", "o", "row_number() over (partition by k order by o) - 1 i",
                             "count(*) over (partition by k) stack_n")
    assert got.select("k", "o", "i", "stack_n").exceptAll(expected).count() == 0
    assert got.count() == 20000


def test_dictionary_codes_are_dense_and_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("Z",), ("b",), (None,)], "c string")
    assert rows_of(SP.encode_dictionary(df, "c", "i"), "c") == [(None, None), ("Z", 0), ("a", 1), ("b", 2), ("b", 2)]


def test_score_profile_takes_lowest_score_of_the_newest_day(spark):
    data = [("a", DAY, 100), ("a", DAY, 87), ("a", dt.date(2026, 1, 1), 60), ("b", dt.date(1960, 1, 1), 5)]
    df = spark.createDataFrame(data, "k string, d date, s int")
    got = rows_of(RK.score_profile(df, "k", "s", "d"), "k")
    assert got == [("a", 3, 82.33, 60, 100, DAY, 87), ("b", 1, 5.0, 5, 5, dt.date(1960, 1, 1), 5)]


def test_mean_rounding_goes_to_even(spark):
    df = spark.createDataFrame([("a", DAY, s) for s in [97] * 7 + [98]], "k string, d date, s int")
    assert RK.score_profile(df, "k", "s", "d").first().mean_score == 97.12


def test_ranking_ties_and_slots(spark):
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 2, 1)
    data = [("a", 90.0, 5, d1, "v1"), ("b", 90.0, 6, d1, "v2"), ("c", 90.0, 6, d2, "v3"),
            ("d", 95.0, 5, d1, "v4"), ("e", 94.0, 9, d1, "v4"), ("f", 99.0, 4, d1, "v5")]
    df = spark.createDataFrame(data, "k string, mean_score double, n int, latest date, venue string")
    top = RK.rank_table(df, "top", "k", 5, ["venue"])
    assert [(r.rank, r.k) for r in top.orderBy("rank").collect()] == [(1, "d"), (2, "c"), (3, "b"), (4, "a")]
    low = RK.rank_table(df, "bottom", "k", 3, ["venue"], k=2)
    assert [(r.rank, r.k) for r in low.orderBy("rank").collect()] == [(1, "c"), (2, "b")]


def test_category_filter_comes_before_the_slot_rule(spark):
    data = [("a", 99.0, 5, DAY, "v", "shop"), ("b", 98.0, 5, DAY, "v", "food")]
    df = spark.createDataFrame(data, "k string, mean_score double, n int, latest date, venue string, category string")
    got = RK.rank_tables(df, "k", "category", "food", ["venue"])
    assert {(r.table, r.k) for r in got.collect()} == {
        ("all_top", "a"), ("all_bottom", "b"), ("chosen_top", "b"), ("chosen_bottom", "b")}


def test_union_keeps_every_observation(spark):
    schema = "k string, d date, s int, id string"
    portal = spark.createDataFrame([("x", DAY, 100, "p1"), ("x", DAY, 100, "p2")], schema)
    batch = spark.createDataFrame([("x", DAY, 100, "b1"), ("x", DAY, 87, "b2"), ("x", DAY, None, "b3")], schema)
    merged = M.union_dedupe([("portal", portal), ("batch", batch)], ["k", "d", "s"], ["id"])
    assert {(r.s, r.id, r.source) for r in merged.collect()} == {
        (100, "p1", "portal"), (87, "b2", "batch"), (None, "b3", "batch")}
    assert M.lost_keys(batch, merged, ["k", "d", "s"]).count() == 0
    assert rows_of(M.lost_keys(batch, portal, ["k", "d", "s"]), "s") == [("x", DAY, None), ("x", DAY, 87)]


def test_annotation_never_changes_the_row_count(spark):
    df = spark.createDataFrame([("a", None), ("a", "own"), ("b", None)], "k string, t string")
    lookup = spark.createDataFrame([("a", "first", 1), ("a", "second", 2)], "k string, v string, o int")
    got = M.annotate_missing(df, lookup, ["k"], {"t": "v"}, ["o"])
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("a", "first"), ("a", "own"), ("b", "-")]


def test_cache_passes(spark):
    schema = "query string, street_norm string, city string, zip5 string, latitude double, longitude double, source string"
    cache = spark.createDataFrame([("q1", "s", "c", "z", 1.0, 1.0, "census"), ("q2", "s", "c", "z", None, None, None),
                                   ("q2", "s", "c", "z", 2.0, 2.0, "census")], schema)
    one = G.one_per_query(cache)
    assert one.count() == 2 and one.filter("latitude IS NULL").count() == 0
    base = spark.createDataFrame([("q1", "s", "c", "z", 1.0, 1.0, "census"), ("q2", "s", "c", "z", None, None, None),
                                  ("q3", "s", "c", "z", None, None, None)], schema)
    answers = spark.createDataFrame([("q2", 5.0, 6.0), ("q3", None, None), ("q9", 1.0, 1.0), ("q1", 8.0, 8.0)],
                                    "query string, latitude double, longitude double")
    got = {r["query"]: (r.latitude, r.source) for r in G.retry_pass(base, answers, "arcgis").collect()}
    assert got == {"q1": (1.0, "census"), "q2": (5.0, "arcgis"), "q3": (None, None)}


def test_unstack_leaves_single_points_alone(spark):
    df = spark.createDataFrame([("a", 30.0, -97.0), ("b", 30.0, -97.0), ("c", 31.0, -97.0)], "id string, y double, x double")
    got = {r.id: (r.i, r.stack_n, r.lat_out, r.lon_out) for r in G.unstack(df, "y", "x", ["id"]).collect()}
    assert got["a"] == (0, 2, 30.0, -97.0) and got["c"] == (0, 1, 31.0, -97.0)
    assert got["b"][:2] == (1, 2) and got["b"][2:] != (30.0, -97.0)


def test_window_audit(spark):
    full = [("w1", i * 25, "ok", 25) for i in range(9)]
    data = full + [("w2", 0, "ok", 25), ("w2", 25, "ok", 3), ("w3", 0, "ok", 25), ("w3", 25, "end", 0),
                   ("w4", 0, "ok", 25), ("w4", 25, "fault", 0), ("w5", 0, "ok", 25),
                   ("w6", 0, "ok", 25), ("w6", 25, "fault", 0), ("w6", 0, "ok", 25), ("w6", 25, "ok", 1)]
    rows = [(f"2026-01-01 00:{i:02d}:00", *r) for i, r in enumerate(data)]
    log = spark.createDataFrame(rows, "ts string, window string, start int, outcome string, n int")
    assert rows_of(FE.window_audit(log), "window") == [
        ("w1", "capped", 225, 0), ("w2", "done", 28, 0), ("w3", "done", 25, 0), ("w4", "failed", 25, 1),
        ("w5", "interrupted", 25, 0), ("w6", "done", 26, 1)]


def test_window_plan_clips_the_last_window(spark):
    bounds = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 1, 5))], "a date, b date")
    got = rows_of(FE.window_plan(bounds, "a", "b"), "from_day")
    assert got == [(dt.date(2026, 1, 1), dt.date(2026, 1, 2)), (dt.date(2026, 1, 3), dt.date(2026, 1, 4)),
                   (dt.date(2026, 1, 5), dt.date(2026, 1, 5))]


def test_weeks_missing_on_one_side(spark):
    left = spark.createDataFrame([(dt.date(2026, 3, 1),), (dt.date(2026, 3, 7),)], "d date")
    right = spark.createDataFrame([(dt.date(2026, 3, 7),), (dt.date(2026, 3, 8),)], "d date")
    assert rows_of(RC.weekly_counts(left, right, "d"), "week") == [(dt.date(2026, 3, 1), 2, 1, -1, 50.0)]
    assert rows_of(RC.weekly_counts(left, right, "d", how="full"), "week") == [
        (dt.date(2026, 3, 1), 2, 1, -1, 50.0), (dt.date(2026, 3, 8), 0, 1, 1, None)]


def test_systematic_shortfall(spark):
    weeks = spark.createDataFrame([(i, 100, 90, 90.0) for i in range(11)], "w int, left_n int, right_n int, pct double")
    assert RC.weekly_summary(weeks).first().systematic is True
    assert RC.weekly_summary(weeks.filter("w < 10")).first().systematic is False


def test_search_needs_two_characters(spark):
    df = spark.createDataFrame([("Joe's Diner", "1 Elm"), ("Ann's", "2 Joe St")], "n string, a string")
    assert FA.search(df, ["n", "a"], "j", ["n"]).count() == 0
    assert [r.n for r in FA.search(df, ["n", "a"], " JOE ", ["n"]).collect()] == ["Ann's", "Joe's Diner"]


def test_empty_bands_count_zero(spark):
    df = spark.createDataFrame([(95,), (None,)], "s int")
    assert rows_of(AG.band_counts(df, "s"), "position") == [(0, "red", 0), (1, "orange", 0), (2, "yellow", 0), (3, "green", 1)]


def test_checks_can_fail(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 5)], "k string, v int")
    results = Q.run_checks([
        Q.RowChecks(df, {"key": F.col("k").isNotNull(), "null is failure": F.col("k") == "a", "fine": F.col("v") > 0}),
        Q.no_duplicates("unique", df, ["k", "v"]), Q.not_empty("rows", df.filter("v > 9")),
        Q.free_of("marker", df, "zz"),
    ])
    assert {r.label: (r.ok, r.n_bad) for r in results.collect()} == {
        "key": (False, 1), "null is failure": (False, 1), "fine": (True, 0), "unique": (False, 1),
        "rows": (False, 1), "marker": (True, 0)}
    assert Q.verdict(results).first().asDict() == {"n_run": 6, "n_passed": 2, "n_failed": 4, "ok": False}


def test_ranking_check_sees_a_swap(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "rank int, k string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "rank int, k string")
    assert Q.run_checks([Q.same_ranking("r", a, b)]).first().ok is False
    assert Q.run_checks([Q.same_ranking("r", a, a)]).first().ok is True


def test_spread_join_equals_a_plain_join(spark):
    facts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 40).alias("k"), "id")
    dims = spark.range(30).select((F.col("id") + 5).alias("k"), F.col("id").alias("w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain, spread = facts.join(dims, "k", how), SP.spread_join(facts, dims, ["k"], how)
        spread = spread.select(*plain.columns)
        assert spread.count() == plain.count()
        assert spread.exceptAll(plain).count() == 0


SPLIT_SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}


def test_spread_join_splits_a_hot_key(spark):
    """A third of the rows share a key, and the other side was aggregated on it."""
    for key, value in SPLIT_SMALL.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha1(F.col("id").cast("string")).alias("w"))
        dims = spark.range(90_000).withColumnRenamed("id", "k").groupBy("k").agg(F.count("*").alias("n"))
        joined = SP.spread_join(facts, dims, ["k"], "left")
        assert len(joined.collect()) == 90_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in SPLIT_SMALL:
            spark.conf.unset(key)


def test_chained_spread_joins_read_each_input_once(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "k").write.parquet(f"{tmp_path}/t")
    out = spark.read.parquet(f"{tmp_path}/t")
    for n in range(1, 5):
        out = SP.spread_join(out, spark.read.parquet(f"{tmp_path}/t").withColumn(f"v{n}", F.lit(n)), ["k"], "left")
        assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == n + 1


def test_score_profile_takes_any_number(spark):
    from recordlens.operators.ranking import score_profile

    rows = spark.createDataFrame([("a", -5.0, "2024-01-02"), ("a", 7.0, "2024-01-02"), ("a", 9.0, "2024-01-01")],
                                 "k string, s double, d string").selectExpr("k", "s", "date(d) AS d")
    row = score_profile(rows, "k", "s", "d").first()
    assert (row.n, row.min_score, row.max_score, row.latest_score) == (3, -5, 9, -5)
