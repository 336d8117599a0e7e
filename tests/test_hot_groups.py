"""One block, name, day or key holding much of the data must not make work quadratic.

Each case would emit hundreds of millions of pairs if a group's members were paired up.
"""

import time

import pytest
from pyspark.sql import functions as F

from recordlens.operators import resolve as R
from recordlens.operators import select as S

N = 20_000
LIMIT_SECONDS = 120


@pytest.fixture(autouse=True)
def bounded_time():
    started = time.time()
    yield
    assert time.time() - started < LIMIT_SECONDS


def side(spark, ident, prefix):
    """A third of the entities are copies at one address, the rest stand alone."""
    i = F.col("id").cast("string")
    hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        F.concat(F.lit(prefix), F.lpad(i, 6, "0")).alias(ident),
        F.when(hot, "diner").otherwise(F.concat(F.lit("n"), i)).alias("name"),
        F.when(hot, "1main").otherwise(F.concat(i, F.lit("oak"))).alias("street"),
        F.lit("78704").alias("zip"), hot.alias("hot"), "id",
    )


def events_of(entities, ident):
    return entities.select(
        ident, F.explode(F.sequence(F.lit(1), F.lit(4))).alias("n"), "hot", "id"
    ).select(ident, F.when(F.col("hot"), F.col("n")).otherwise(F.col("id") + F.col("n")).alias("day"),
             F.lit(95).alias("score"))


def test_copies_in_one_block(spark):
    a, b = side(spark, "a", "a"), side(spark, "b", "b")
    events = R.Events(events_of(a, "a"), events_of(b, "b"), ("day", "score"))
    found = R.tier_match(a, b, "a", "b", [("t", ("name", "street", "zip"))], events)
    n_hot = len(range(0, N, 3))
    assert found.matched.count() == N - n_hot
    assert found.matched.filter(F.substring("a", 2, 6) != F.substring("b", 2, 6)).count() == 0
    open_rows = found.unresolved.agg(F.count("*").alias("n"), F.min("n_candidates").alias("c")).first()
    assert (open_rows.n, open_rows.c) == (n_hot, n_hot)
    assert found.members.count() == n_hot


def test_one_winner_for_a_whole_block_of_copies(spark):
    """Every hot permit shares most events with the same single facility."""
    a, b = side(spark, "a", "a"), side(spark, "b", "b")
    special = spark.createDataFrame([("b000000", d, 95) for d in (1, 2, 3)], "b string, day long, score int")
    others = events_of(b.filter("b <> 'b000000'"), "b").withColumn("day", F.col("day") + 1_000_000)
    events = R.Events(events_of(a, "a"), special.unionByName(others), ("day", "score"))
    found = R.tier_match(a, b, "a", "b", [("t", ("name", "street", "zip"))], events)
    hot = found.matched.filter("match_method = 't+events'")
    assert hot.count() == len(range(0, N, 3))
    assert [tuple(r) for r in hot.select("b", "n_shared_events").distinct().collect()] == [("b000000", 3)]


def test_many_names_at_one_address(spark):
    """Names at one address are looked up by substring, and copies of a name count once."""
    n = 4000
    word = F.substring(F.sha1(F.col("id").cast("string")), 1, 8)
    place = [F.lit("1main").alias("street"), F.lit("78704").alias("zip")]
    a = spark.range(n).select(F.concat(F.lit("a"), "id").alias("a"), F.concat(word, F.lit("zz")).alias("an"), *place)
    b = spark.range(n).select(F.concat(F.lit("b"), "id").alias("b"), word.alias("bn"), *place)
    none = lambda c: spark.createDataFrame([], f"{c} string, day int, score int")
    events = R.Events(none("a"), none("b"), ("day", "score"))
    got = R.corroborated_match(a, b, "a", "b", ("street", "zip"), "an", "bn", events, min_len=3)
    assert got.count() == n
    assert got.filter(F.substring("a", 2, 9) != F.substring("b", 2, 9)).count() == 0


def test_a_very_long_name(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(10_000))
    a = spark.createDataFrame([("a1", "x", long), ("a2", "x", "owl")], "a string, block string, a_name string")
    b = spark.createDataFrame([("b1", "x", long[4000:4020]), ("b2", "x", "blueowlcafe"), ("b3", "y", long)],
                              "b string, block string, b_name string")
    got = {(r.a_name == long, r.low, r.high) for r in R._names_that_contain(a, b, "b", 1).collect()}
    assert got == {(True, "b1", "b1"), (False, "b2", "b2")}


def test_an_event_shared_by_a_whole_block_brings_no_pairs(spark):
    """All classes share one event; each has a partner with which it shares two more."""
    def classes(prefix):
        day = lambda d: F.struct(d.cast("long").alias("day"))
        name = F.concat(F.lit(prefix), "id")
        return spark.range(N).select(F.lit("x").alias("block"), name.alias("low"), name.alias("high"), F.lit(1).alias("size"),
                                     F.array(day(F.lit(0)), day(F.col("id") * 2 + 1), day(F.col("id") * 2 + 2)).alias("events"))
    got = R._shared_by_class(classes("a"), classes("b"), 2)
    assert got.count() == N
    assert got.filter("substr(a_rep, 2) <> substr(b_low, 2) OR shared <> 3").count() == 0


def test_handoff_rules_out_a_huge_block(spark):
    many = spark.range(N).select(
        F.lit("hot").alias("block"), F.concat(F.lit("f"), "id").alias("b"), F.lit("1").alias("num"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2000).cast("int")).alias("lo"))
    pair = spark.createDataFrame([("calm", "x", "1", "2020-01-01"), ("calm", "y", "1", "2021-01-01")],
                                 "block string, b string, num string, lo string").withColumn("lo", F.col("lo").cast("date"))
    spans = many.unionByName(pair).withColumn("hi", F.col("lo"))
    a = spark.createDataFrame([("p1", "hot", "1", "n"), ("p2", "calm", "1", "n")], "a string, block string, num string, label string")
    matches, merges = R.handoff_merge(a.select("a", "block"), spans.select("block", "b"), a.drop("block"),
                                      spans.drop("block"), "a", "b", "num", "label", "lo", "hi")
    assert [(r.a, r.b) for r in matches.collect()] == [("p2", "y")]
    assert [(r.old_id, r.new_id, r.gap_days) for r in merges.collect()] == [("x", "y", 366)]


def test_copies_of_one_record_on_one_day(spark):
    df = spark.range(3_000_000).select(F.lit("k").alias("k"), F.lit("2026-01-01").cast("date").alias("d"),
                                       (F.col("id") % 3).cast("int").alias("v"))
    row = S.same_date_conflicts(df, ["k"], "d", "v").first()
    assert (row.n_rows, row.values_text) == (3_000_000, "0 x1000000 / 1 x1000000 / 2 x1000000")
    assert S.dedupe_prefer(df, ["k"], ["d", "v"]).count() == 1
