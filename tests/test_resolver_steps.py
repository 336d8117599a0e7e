"""The resolver's dear steps stand once in its plans, whatever reads them."""

from pyspark.sql import functions as F

from recordlens.fixed_values import CITIES, CITY_SPELLING, NAME_PREFIX_CITY
from recordlens.functions.address import clean_city, derive_city
from recordlens.operators import resolve as R
from recordlens.operators import select as S
from recordlens.session import materialise


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


class Staged:
    """Stages like ``materialise`` and keeps the plans of what it wrote."""

    def __init__(self):
        self.plans = []

    def __call__(self, df):
        self.plans.append(_plan(df))
        return materialise(df)


def _sides(spark):
    """p1 and p2 meet two facilities each; only p1 shares more with one of them than with the other."""
    a = spark.createDataFrame([("p1", "x", "1"), ("p2", "y", "2"), ("p3", "z", "3")], "a string, name string, num string")
    b = spark.createDataFrame([("f1", "x", "1"), ("f2", "x", "1"), ("f3", "y", "2"), ("f4", "y", "2"), ("f5", "z", "3")],
                              "b string, name string, num string")
    seen = lambda rows, c: spark.createDataFrame(rows, f"{c} string, day int, score int")
    events = R.Events(seen([("p1", d, 9) for d in (1, 2, 3)] + [("p2", 1, 9)], "a"),
                      seen([("f1", d, 9) for d in (1, 2, 3)] + [("f2", 1, 9), ("f2", 2, 9), ("f3", 1, 9), ("f4", 1, 9)], "b"),
                      ("day", "score"))
    return a, b, events


def test_event_sets_are_gathered_once_per_side(spark):
    a, b, events = _sides(spark)
    stage = Staged()
    found = R.tier_match(a, b, "a", "b", [("t", ("name", "num"))], events, stage=stage)
    plans = [*stage.plans, _plan(found.matched), _plan(found.unresolved)]
    assert sum(p.count("collect_set(") for p in plans) == 2
    assert sorted((r.a, r.b, r.n_shared_events) for r in found.matched.collect()) == [("p1", "f1", 3), ("p3", "f5", None)]
    assert [tuple(r) for r in found.unresolved.collect()] == [("p2", "t", "y|2", 2)]


def test_corroboration_gathers_event_sets_once_per_side(spark):
    a, b, events = _sides(spark)
    stage = Staged()
    got = R.corroborated_match(a.withColumn("n", F.lit("owl")), b.withColumn("n", F.lit("cat")), "a", "b", ("name", "num"),
                               "n", "n", events, min_shared=3, stage=stage)
    assert sum(p.count("collect_set(event") for p in [*stage.plans, _plan(got)]) == 2
    assert [(r.a, r.b, r.n_shared_events) for r in got.collect()] == [("p1", "f1", 3)]


def test_the_last_plan_of_corroboration_holds_no_step_that_found_matches(spark):
    """The counts read the matches three times; the driver held all steps as often, in one plan."""
    a, b, events = _sides(spark)
    stage = Staged()
    named = lambda df, name: df.withColumn("n", F.lit(name))
    got = R.corroborated_match(named(a, "owl"), named(b, "owls"), "a", "b", ("name", "num"), "n", "n", events, min_shared=3,
                               stage=stage)
    steps = ("explode(_parts", "array_intersect(", "row_number(")
    assert not [s for s in steps if s in _plan(got)]
    assert [sum(p.count(s) for p in stage.plans) for s in steps] == [2, 1, 2]
    assert not [p for p in stage.plans if "explode(_parts" in p and "array_intersect(" in p]
    assert [tuple(r) for r in got.collect()] == [("p3", "f5", "street+zip+name_corroborated", "address+name_containment", 0)]


def test_merges_read_the_chains_that_the_matches_found(spark):
    day = lambda c: F.col(c).cast("date").alias(c)
    b = spark.createDataFrame([("f1", "1", "2020-01-01", "2020-02-01"), ("f2", "1", "2022-01-01", "2022-02-01")],
                              "b string, num string, lo string, hi string").select("b", "num", day("lo"), day("hi"))
    a = spark.createDataFrame([("p1", "1", "Owl"), ("p2", "1", "Cat")], "a string, num string, label string")
    stage = Staged()
    matches, merges = R.handoff_merge(a.select("a", F.lit("k").alias("block")), b.select("b", F.lit("k").alias("block")), a, b,
                                      "a", "b", "num", "label", "lo", "hi", stage=stage)
    assert "lag(" not in _plan(merges) and "lag(" not in _plan(matches)
    assert sum(p.count("lag(") for p in stage.plans) == 1
    assert sorted((r.a, r.b) for r in matches.collect()) == [("p1", "f2"), ("p2", "f2")]
    assert [(r.old_id, r.new_id, r.business) for r in merges.collect()] == [("f1", "f2", "Owl")]


def test_a_report_reads_the_crosswalk_once(spark):
    rows = [("matched", "t", "exact")] * 5 + [("unmatched", None, None)] * 3
    report = R.match_report(spark.createDataFrame(rows, "status string, match_method string, confidence string"))
    assert "scalar-subquery" not in _plan(report)
    assert [(r.status, r.n, r.pct) for r in report.collect()] == [("matched", 5, 62.5), ("unmatched", 3, 37.5)]
    assert R.match_report(spark.createDataFrame([], "status string, match_method string, confidence string")).count() == 0


def test_a_profile_carries_each_column_once(spark):
    df = spark.createDataFrame([("k", 2, "b", "x"), ("k", 1, "c", None), ("k", 1, "b", "y"), ("k", None, "a", "z"), ("l", None, None, "w")],
                               "k string, d int, name string, city string")
    profile = S.entity_profile(df, "k", {"first": "name", "town": "city", "again": "name"}, "d", ["d", "name"])
    assert "min_by" not in _plan(profile)
    assert sorted(tuple(r) for r in profile.collect()) == [("k", "b", "y", "b", 1, 2, 4), ("l", None, "w", None, None, None, 1)]


def test_a_city_is_looked_for_once(spark):
    prefix, place = next((k, v) for k, v in NAME_PREFIX_CITY.items() if v != "Austin")
    texts = [f"12 Main St{mark}{city}" for city in CITIES for mark in (" ", ", ") for city in (city, city.upper(), city.lower())]
    texts += ["1 A St Austin\u0085", "1 A St  AUSTIN \n", "1 Austin Ave", "Austinn", "", None, "1 B St, West  Lake Hills"]
    df = spark.createDataFrame([(t, n) for t in texts for n in (f"{prefix} - Owl", "Owl", None)], "address string, name string")
    got = df.select("address", "name", derive_city("address", "name").alias("city"))
    assert _plan(got).count("West Lake Hills|") == 1
    for r in got.collect():
        ends = [c for c in CITIES if " ".join((r.address or "").lower().split()).endswith(c.lower())]
        code = place if r.name and r.name.startswith(prefix) else "Austin"
        assert r.city == (CITY_SPELLING.get(ends[0], ends[0]) if ends else code), r
    cities = spark.createDataFrame([(c,) for c in CITIES], "c string").select("c", clean_city("c").alias("clean"))
    assert all(r.clean == CITY_SPELLING.get(r.c, r.c) for r in cities.collect())
