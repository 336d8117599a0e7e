"""Literal cases of every text, address, classification and date rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordlens import fixed_values as V
from recordlens.functions import address as A
from recordlens.functions import classify as C
from recordlens.functions import dates as D
from recordlens.functions import text as T


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


def apply_rows(spark, fn, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.y for r in df.select("i", fn().alias("y")).orderBy("i").collect()]


CASES = [
    (T.squish, ["  a \t b\n\nc ", "", None, "x  y"], ["a b c", "", None, "x y"]),
    (T.title_case, ["O'BRIEN STOP-N-GO 5TH", "mcdonald's l.c. h-e-b", "123.main"],
     ["O'brien Stop-N-Go 5th", "Mcdonald's L.c. H-E-B", "123.Main"]),
    (T.display_name,
     ["PF - Wingstop", "7 - Eleven Convenience Store", "Stop - N - Express",
      "ABIA - Amy's Ice Cream", "LW-  Pizza"],
     ["Wingstop", "7 - Eleven Convenience Store", "Stop - N - Express",
      "ABIA - Amy's Ice Cream", "Pizza"]),
    (T.venue_of, ["Levy at Q2 Stadium/South Main 103", "Arby's 8888", "Raising Canes # 194",
                  "Deli Store 12", "Cafe No. 5"],
     ["Levy at Q2 Stadium", "Arby's", "Raising Canes", "Deli", "Cafe"]),
    (T.norm_name, ["ABIA Amy's Ice Cream", "PF Chang's", "PF - Chang's", "OOB-Donut 4U"],
     ["abiaamysicecream", "pfchangs", "changs", "donut4u"]),
    (T.loose_name, ["ABIA Amy's Ice Cream", "PF Chang's", "7-Eleven - #23621 Vaishnavi", "OOB -"],
     ["amysicecream", "changs", "7elevenvaishnavi", ""]),
    (T.norm_street, ["300 S Lamar Blvd Ste 12", "12 Unity Rd"], ["300slamarblvd12", "12unityrd"]),
    (T.house_num, ["  300 S Lamar", "S Lamar 3", None], ["300", None, None]),
    (T.zip5, ["78704-1234", "7870", None], ["78704", None, None]),
    (T.to_int, ["87.5", "abc", "", "-3", None], [87, None, None, -3, None]),
    (lambda x: T.truncate(x, 8), ["short", "exactly8", "longer text"], ["short", "exactly8", "longe..."]),
    (A.street_only,
     ["106 CANYON RIDGE, AUSTIN, TX, 78753 Austin", "1234 Oak Manor Austin", "5 Elm St, Bee Caves"],
     ["106 CANYON RIDGE", "1234 Oak Manor", "5 Elm St"]),
    (A.display_street,
     ["11150 RESEARCH SB BLVD Unit 210A", "3811 N Ih 35", "5204 Fm 2222", "11920 e Us 290 Hwy Wb",
      "15812 Windermere Dr Ste 200 # Bunit", "1 Main St Bunit 300", "9 SVRD Rd #", "2 Ste A Rm 1154.2"],
     ["11150 Research SB Blvd Unit 210A", "3811 N IH 35", "5204 FM 2222", "11920 E US 290 Hwy WB",
      "15812 Windermere Dr Ste 200", "1 Main St Unit 300", "9 Service Rd Rd", "2 Ste A Rm 1154.2"]),
    (A.normalize_street,
     ["100 MAIN ST", "12 N IH-35 SVRD NB", "5 Elm St Ste 900", "7 Oak # 4", "8 FM620 Bunit 3",
      "9 Hwy 71"],
     ["100 Main St", "12 N I-35 Service Rd", "5 Elm St", "7 Oak", "8 FM 620", "9 Highway 71"]),
    (C.categorize,
     ["Mandola's Italian Market", "LW - Lakeway Market", "Dell Children's Medical Center",
      "Growing Imaginations L.C.", "County Line", "Westgate II", "7-Eleven", "COTA Stand",
      "Total Wine", "Little School", "Aramark", None],
     [V.RESTAURANT, V.GROCERY, V.HEALTHCARE, V.SCHOOL, V.RESTAURANT, V.RETAIL, V.CONVENIENCE,
      V.VENUE, V.RETAIL, V.SCHOOL, V.INSTITUTIONAL, V.RESTAURANT]),
]


@pytest.mark.parametrize("fn,values,expected", CASES, ids=range(len(CASES)))
def test_text_rules(spark, fn, values, expected):
    assert apply(spark, fn, values) == expected


def test_bands(spark):
    values = [69.0, 69.67, 70.0, 79.0, 79.5, 89.0, 90.0, None]
    assert apply(spark, C.band, values, "double") == [
        "red", "orange", "orange", "orange", "yellow", "yellow", "green", None]
    three = apply(spark, lambda x: C.closed_band(x, part=4, missing="gray"), [69.0, 69.5, 85.0, 86.0, 101.0, None], "double")
    assert three == ["red", "gray", "gold", "green", "gray", "gray"]


def test_is_scored(spark):
    rows = [(95, None), (0, None), (0, "Wholesale"), (98, "Wholesale"), (None, None), (98, V.SCORED_TYPE)]
    got = apply_rows(spark, lambda: C.is_scored("s", "t"), rows, "s int, t string")
    assert got == [True, False, False, False, False, True]


def test_city(spark):
    rows = [("5 Elm St Bee Caves", "x"), ("5 Elm", "PF - Wingstop"), ("5 Elm", "Wingstop"),
            ("5 Elm WEST LAKE HILLS", "x"), (None, "COTA - Stand"), ("5 Elm", "PFX - Wing")]
    got = apply_rows(spark, lambda: A.derive_city("a", "n"), rows, "a string, n string")
    assert got == ["Bee Cave", "Pflugerville", "Austin", "West Lake Hills", "Austin", "Austin"]


def test_geocode_query(spark):
    rows = [("2538 Elmont Dr., 78741", "Austin", None, None), ("13101 Tesla Rd", "Austin", None, None),
            ("5 Elm St", "Austin", "78704", "5 Elm St 78799"), (None, "Austin", "78704", None),
            ("5 Elm St", "Austin", "", "5 Elm St, 78799")]
    got = apply_rows(spark, lambda: A.geocode_query("s", "c", "z", "a"), rows,
                     "s string, c string, z string, a string")
    assert got == ["2538 Elmont Dr., Austin, TX, 78741", "13101 Tesla Rd, Austin, TX",
                   "5 Elm St, Austin, TX, 78704", None, "5 Elm St, Austin, TX, 78799"]


def test_dates(spark):
    days = [dt.date(2026, 3, 1), dt.date(2026, 3, 4), dt.date(2026, 8, 4), dt.date(2025, 2, 4)]
    assert apply(spark, D.week_start, days[:2], "date") == [dt.date(2026, 3, 1)] * 2
    assert apply(spark, D.ap_date, days[1:], "date") == ["March 4, 2026", "Aug. 4, 2026", "Feb. 4, 2025"]
    assert apply(spark, D.long_date, days[2:3], "date") == ["August 4, 2026"]
    for newest, cutoff in ((dt.date(2026, 8, 4), dt.date(2025, 2, 4)), (dt.date(2026, 8, 31), dt.date(2025, 2, 28))):
        df = spark.createDataFrame([(newest,), (dt.date(2020, 1, 1),)], "d date")
        assert df.select(D.recency_cutoff(df, "d").alias("c")).first().c == cutoff


def test_containment(spark):
    rows = [("abc", "b"), ("b", "abc"), ("", "abc"), ("", ""), ("none", "nonesuch"), ("x", "y"), (None, "y")]
    got = apply_rows(spark, lambda: F.coalesce(T.either_contains("a", "b"), F.lit(False)), rows, "a string, b string")
    assert got == [True, True, False, False, True, False, False]


def test_fixed_value_shapes():
    assert set(V.DISPLAY_CITY_CODES) == set(V.NAME_PREFIX_CITY) - {"ABIA", "COTA"}
    assert len(V.AP_MONTHS) == 12 and len(V.CATEGORIES) == 8
    assert {label for label, _ in V.CATEGORY_RULES} == set(V.CATEGORIES)
    assert sum(len(p) for _, p in V.CATEGORY_RULES) == 156
