"""Indexed search against a scan, and rules applied once per distinct value."""

import random

from pyspark.sql import functions as F

from recordlens.functions.classify import categorize
from recordlens.operators.search_index import SearchIndex
from recordlens.operators.spread import by_distinct


def test_search_equals_a_scan_and_reads_few_folders(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 40))), rng.choice([None, "S", "t"])) for i in range(600)]
    rows += [(1, "zebra crossing", None), (1, "quagga", "x"), (None, "zebra", None), (900, "", None), (901, None, None)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    index = SearchIndex(str(tmp_path / "index"), "id")
    index.build(df, ["a", "b"])
    for text in ["ab", "abc", " ZEBRA ", "bra c", "é é", "g", "", "zzz", "aaaaa", "a s", "quagga x", "cab", "b a b"]:
        wanted = text.strip().lower()
        want = [r for r in rows if len(wanted) >= 2 and wanted in " ".join(x for x in r[1:] if x is not None).lower()]
        got = [tuple(r) for r in index.find(spark, text).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), text
    plan = index.find(spark, "zebra")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan and "PushedFilters: [In(gram" in plan


def test_runs_are_listed_by_folder_and_cut_by_characters(spark, tmp_path):
    # One id for many rows, and characters of four bytes: runs are made of whole characters.
    rows = [(None, f"text {i} \U0001F600\U0001F601é\n{i % 7}") for i in range(64)]
    index = SearchIndex(str(tmp_path / "index"), "id")
    index.build(spark.createDataFrame(rows, "id long, a string"), ["a"])
    lists = spark.read.parquet(f"{tmp_path}/index/lists")
    by_file = lists.groupBy(F.col("_metadata.file_name")).agg(F.count_distinct("_part").alias("n")).collect()
    assert len(by_file) > 8 and all(r.n == 1 for r in by_file)
    got = {(r._part, r.gram) for r in lists.collect()}
    texts = spark.read.parquet(f"{tmp_path}/index/rows").collect()
    want = {(r._part, r._text[i:i + n]) for r in texts for n in (2, 3) for i in range(len(r._text) - n + 1)}
    assert got == want
    assert index.find(spark, "\U0001F601é\n3").count() == len([i for i in range(64) if i % 7 == 3])


def test_rules_run_above_the_deduplication_only(spark):
    names = ["Corner Market", "Sunny Elementary", None, "A", "Corner Market"] * 400
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    got = by_distinct(df, "name", "category", categorize)
    want = df.withColumn("category", categorize("name"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    with_rules = [line.strip(" :+-") for line in plan.splitlines() if "rlike" in line.lower()]
    assert len(with_rules) == 1 and with_rules[0].startswith("Aggregate [name")
