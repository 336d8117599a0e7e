"""Published documents, keyed differences and check details."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordlens import fixed_values as V
from recordlens.operators import quality as Q
from recordlens.operators.compare import differences
from recordlens.plans import gate
from recordlens.sources.published import Document, read_document, write_document


def written(spark, tmp_path, rows, parts=1):
    df = spark.createDataFrame(rows, "n string, a string, s int, d string, y double").repartition(parts)
    header = spark.range(1).select(
        F.lit("2024-01-01").alias("cutoff"), F.lit("2024-12-31").alias("data_through"), F.lit(len(rows)).alias("n_mapped"),
        F.array(*[F.struct(F.lit(b[2]).alias("color")) for b in V.BANDS]).alias("buckets"), F.lit(None).cast("string").alias("note"))
    path = str(tmp_path / f"doc{parts}")
    write_document(df.withColumns({"_o": -F.col("s"), "_t": F.col("n")}), header, path, ["_o", "_t"])
    return path


ROWS = [("a\"b\n", "x, y", 5, "2024-02-01", 1.5), ("b", None, 90, "2024-03-01", -0.1), ("c", "é]}", 7, "2024-02-02", 1e-7)]


@pytest.mark.parametrize("rows", [ROWS, [], [(f"r{i}", "a", i % 100, "2024-05-05", 0.0) for i in range(3000)]])
def test_a_document_is_one_json_object_in_order_whatever_the_tasks(spark, tmp_path, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = written(spark, tmp_path, rows, 5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(Path(path).glob("part-*"))
    assert len(parts) > 1 or len(rows) < 100
    whole = json.loads("".join(p.read_text() for p in parts))
    assert whole["fields"] == ["n", "a", "s", "d", "y"] and whole["note"] is None
    want = [list(r) for r in sorted(rows, key=lambda r: (-r[2], r[0]))]
    assert whole["rows"] == want
    document = read_document(spark, path)
    got = document.rows.select("place", "n", "a", F.col("s").cast("int"), "d", F.col("y").cast("double")).orderBy("place").collect()
    assert [list(r)[1:] for r in got] == want and [r.place for r in got] == list(range(len(rows)))


def test_the_audit_reads_positions_from_the_header(spark, tmp_path):
    document = read_document(spark, written(spark, tmp_path, [*ROWS, ("z", "CFM", 0, "2020-01-01", 0.0)]))
    mixed = Document({**document.header, "fields": document.header["fields"][::-1]},
                     document.rows.select("place", *document.header["fields"][::-1]))
    verdicts = [sorted(map(tuple, Q.run_detailed(gate.document_checks(d)).collect())) for d in (document, mixed)]
    assert verdicts[0] == verdicts[1]
    assert {(label, n, detail) for label, ok, n, detail in verdicts[0] if not ok} == {
        ("no zero on the map", 1, "z|CFM"), ("every map row is inside the stated window", 1, "z|CFM"),
        ("map carries no inspector comments", 1, "z|CFM")}
    wrong = Document({**document.header, "buckets": document.header["buckets"][::-1], "n_mapped": 3}, document.rows)
    bad = {r.label for r in Q.run_detailed(gate.document_checks(wrong)).filter("NOT ok").collect()}
    assert {"band colours are the published ones", "map rows equal the stated count"} <= bad
    with pytest.raises(ValueError):
        (tmp_path / "none").mkdir()
        read_document(spark, str(tmp_path / "none"))


def test_differences_name_rows_and_columns(spark):
    schema = "k int, m string, v int, w string"
    left = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 1, "x"), (None, "n", 5, None), (4, "d", 1, "p"), (4, "d", 2, "q"), (6, None, 1, "x")], schema)
    right = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 2, None), (None, "n", 5, None), (3, "a", 1, "x"), (4, "d", 1, "p"), (6, None, 1, "x")], schema)
    got = {tuple(r) for r in differences(left, right, ["k", "m"]).collect()}
    assert got == {(2, "a", "changed", "v,w"), (3, "a", "missing", None), (4, "d", "extra", None)}
    assert differences(left, left, ["k", "m"]).isEmpty()
    assert {r.status for r in differences(left.limit(0), right, ["k"]).collect()} == {"missing"}


def test_details_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10).alias("v"))
    seen = set()
    for parts in (1, 3, 40):
        checks = [Q.RowChecks(df.repartition(parts), {"v is not 3": F.col("v") != 3, "v is small": F.col("v") < 10}, key=("k",)),
                  Q.EmptyCheck("none is 17", df.repartition(parts).filter("k = '17'"))]
        seen.add(tuple(sorted(map(tuple, Q.run_detailed(checks).collect()))))
    assert seen == {(("none is 17", False, 1, "17|7"), ("v is not 3", False, 500, "1003; 1013; 1023"), ("v is small", True, 0, None))}
    plain = {tuple(r) for r in Q.run_checks(checks).collect()}
    assert plain == {t[:3] for t in next(iter(seen))}
