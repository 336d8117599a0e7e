"""Steps that many queries share do their dear work once, over many tasks."""

from pyspark.sql import functions as F

from recordlens.functions.address import geocode_query
from recordlens.plans import catalog, geocode, publish, whole
from recordlens.plans import worlds as W


def _tables(spark, path):
    spark.createDataFrame([(1, "ALGERIA")], "n_nationkey int, n_name string").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(k, 1, 100.0 * k, "BUILDING") for k in range(1, 30)], (
        "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string")).coalesce(1).write.parquet(
        f"{path}/customer.parquet")
    rows = [(k, 1 + k % 29, "FOP"[k % 3], 50.0 + k, "5-LOW") for k in range(1, 60)] + [(None, 3, "O", 9.0, None)]
    orders = spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    orders.withColumn("o_orderdate", F.lit("1997-05-01").cast("timestamp")).write.parquet(f"{path}/orders.parquet")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_long_rules_are_dealt_over_tasks_and_stand_once(spark, tmp_path):
    _tables(spark, tmp_path)
    places = W.places(spark, str(tmp_path))
    assert "Repartition" in _plan(places) and places.count() == 29
    rows = [("100 Main St Unit 4, 78701", "Austin", None, None), ("5 IH-35 SVRD", "Austin", "78702", None), (None, "Austin", None, None)]
    df = spark.createDataFrame(rows, "street string, city string, zip5 string, address string")
    keyed = df.select(geocode_query("street", "city", "zip5", "address").alias("q"))
    assert _plan(keyed).count("SVRD") == 1
    assert [r.q for r in keyed.collect()] == ["100 Main St, Austin, TX, 78701", "5 I-35 Service Rd, Austin, TX, 78702", None]


def test_corroboration_in_big_blocks_reads_the_sides_as_written_once(spark, tmp_path):
    spark.createDataFrame([(1, 16, 300.0, "BUILDING"), (2, 16, 600.0, "BUILDING"), (3, 3, 900.0, "BUILDING")], (
        "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string")).write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.createDataFrame([(k, 1 + k % 3, "FOP"[k % 3], 50.0 + k, "5-LOW") for k in range(9)], (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"))
    orders.withColumn("o_orderdate", F.lit("1997-05-01").cast("timestamp")).write.parquet(f"{tmp_path}/orders.parquet")
    got = catalog.corroborated_match_big_blocks(spark, str(tmp_path))
    assert not [f for f in got.inputFiles() if "/orders.parquet" in f or "/customer.parquet" in f]
    method = "street+zip+name_corroborated"
    assert sorted(tuple(r) for r in got.collect()) == [("P1", "F1", method, "address+name_containment", 0),
                                                       ("P2", "F2", method, "address+events", 3)]


def test_records_fetched_twice_are_made_in_one_pass(spark, tmp_path):
    _tables(spark, tmp_path)
    raw = whole.raw_portal(spark, str(tmp_path))
    assert _plan(raw).count("o_orderkey") and _plan(raw).count("Join") == 2  # with the nations, and with the places
    got = sorted((r.inspectionID or "", r.scraped_at[:7], r.score) for r in raw.collect())
    keys = [k for k in range(1, 60) if k % 3]
    new = [(f"I{k}", "2024-02", "N/A" if k % 11 == 0 else str((50 + k) % 101)) for k in keys]
    assert got == sorted([("", "2024-02", "9"), *new])
    thirds = raw.sparkSession.read.parquet(f"{tmp_path}/orders.parquet").withColumn("o_orderstatus", F.lit("O"))
    other = tmp_path / "all"
    _tables(spark, other)
    thirds.write.mode("overwrite").parquet(f"{other}/orders.parquet")
    old = [r for r in whole.raw_portal(spark, str(other)).collect() if r.scraped_at.startswith("2024-01")]
    assert sorted(int(r.inspectionID[1:]) for r in old) == list(range(3, 60, 3)) and {r.score for r in old} == {"1"}


def test_places_are_keyed_once_each(spark):
    ins = spark.createDataFrame([(i, "1 A St", "Austin", "78701", "1 A St") for i in range(50)],
                                "id int, street string, city string, zip5 string, address string")
    assert geocode.keyed_addresses(geocode.distinct_addresses(ins)).count() == 1
    rules = [line for line in _plan(whole._cache(ins)).splitlines() if "SVRD" in line]
    assert len(rules) == 1 and _plan(whole._cache(ins)).count("Aggregate") == 2


def test_a_map_document_locates_facilities_once(spark, tmp_path, monkeypatch):
    calls = []
    real = publish.located_latest
    monkeypatch.setattr(publish, "located_latest", lambda *a: calls.append(a) or real(*a))
    ins = spark.createDataFrame([("F1", "A", "1 A St", "1 A St", "Austin", "78701", 90, "Routine", False, None, "x")], (
        "facility_id string, restaurant_name string, address string, street string, city string, zip5 string, score int, "
        "purpose string, is_followup boolean, inspection_type string, source string")).withColumns({
            "inspection_date": F.lit("2024-01-01").cast("date"), "inspection_id": F.lit("I1")})
    publish.write_map(ins, whole._cache(ins), str(tmp_path / "map"))
    assert len(calls) == 1
    assert '"n_ever":1' in spark.read.text(str(tmp_path / "map")).filter("value like '{%'").first().value
