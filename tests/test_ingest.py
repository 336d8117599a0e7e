"""Landed pages, replayed batches and compaction."""

import json
import pytest

from recordlens import schemas as S
from recordlens.operators.fetch import window_audit
from recordlens.sources import sinks
from recordlens.sources.pages import classify_pages, page_records, quarantined
from recordlens.streaming import ingest


def record(ident, score):
    return {"inspectionID": ident, "permitID": "p", "score": score, "comments": "CFM 1", "extra": 1}


def land(folder, name, pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(
        json.dumps({"window": w, "start": s, "body": b if isinstance(b, str) else json.dumps(b)}) for w, s, b in pages))


def test_page_outcomes(spark):
    pages = [("w", 0, '[{"inspectionID": "a", "score": 95}]'), ("w", 25, '{"err":true,"msg":"bad request"}'),
             ("v", 0, '{"err":true,"msg":"bad request"}'), ("u", 0, "<html>502</html>"), ("t", 0, "[]"),
             ("s", 0, '[{"inspectionID": '), ("r", 0, None),
             ("q", 0, '[{"inspectionID": "a"}] junk')]
    done = classify_pages(spark.createDataFrame(pages, S.LANDED_PAGE))
    got = {(r.window, r.start): (r.outcome, r.n) for r in done.collect()}
    assert got == {("w", 0): ("ok", 1), ("w", 25): ("end", 0), ("v", 0): ("fault", 0), ("u", 0): ("fault", 0),
                   ("t", 0): ("ok", 0), ("s", 0): ("fault", 0), ("r", 0): ("fault", 0),
                   ("q", 0): ("fault", 0)}
    row = page_records(done, "window").first()
    assert (row.window, row.inspectionID, row.score, row.purpose) == ("w", "a", "95", None)
    kept = {r.window: r.body for r in quarantined(done, "window").collect()}
    assert kept == {w: b for w, s, b in pages if w in "vusrq"}


def test_stream_is_idempotent_and_newest_wins(spark, tmp_path):
    landing, target, mark = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "mark")
    land(landing, "1.json", [("w1", 0, [record("a", "90"), record("b", "80")]), ("w1", 25, {"err": True})])
    ingest.ingest_pages(spark, str(landing), target, mark).awaitTermination()
    land(landing, "2.json", [("w2", 0, [record("a", "91"), record("c", "70")]), ("w3", 0, "<html>")])
    ingest.ingest_pages(spark, str(landing), target, mark).awaitTermination()
    ingest.ingest_pages(spark, str(landing), target, mark).awaitTermination()

    assert ingest.read_bronze(spark, target).count() == 4
    current = {r.inspectionID: r.score for r in ingest.current_records(spark, target).collect()}
    assert current == {"a": "91", "b": "80", "c": "70"}
    states = {r.window: r.state for r in window_audit(ingest.read_bronze(spark, target, ingest.LOG)).collect()}
    assert states == {"w1": "done", "w2": "done", "w3": "failed"}

    # A batch replayed after a failure rewrites its own folder and changes nothing.
    batch = spark.read.schema(S.LANDED_PAGE).json(str(landing / "2.json"))
    ingest._write_batch(target)(batch, 1)
    assert ingest.read_bronze(spark, target).count() == 4
    ingest.compact(spark, target, str(tmp_path / "snapshot"))
    assert spark.read.parquet(str(tmp_path / "snapshot")).count() == 3


def test_append_and_rewrite(spark, tmp_path):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    sinks.append_stamped(one, raw)
    sinks.append_stamped(one.filter("id = 'a'"), raw)
    stored = spark.read.parquet(raw)
    assert stored.count() == 3 and stored.filter("scraped_at RLIKE '^[0-9-]{10}T[0-9:]{8}Z$'").count() == 3
    sinks.rewrite_deduped(stored, clean, "id", "scraped_at", ["v"])
    assert spark.read.parquet(clean).count() == 2


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    from recordlens import schemas
    from recordlens.sources import tables

    path = tmp_path / "export.csv"
    path.write_text(
        'score,comments,restaurant_name,facility_id,zip_code,address,inspection_date,process_description,created_at,updated_at,extra\n'
        '95,"first line\nsecond, ""quoted""","Blue ""Owl"" Cafe",77,78701,"1 ELM ST, AUSTIN, TX, 78701",2026-01-02,Routine Inspection,NA,NA,x\n'
        'bad,,Red Fox,78,78702,2 OAK ST,2026-01-03,Routine Inspection,NA,NA,y\n')
    rows = tables.read_table(spark, str(path), schemas.RAW_EXPORT, "csv").orderBy("facility_id").collect()
    assert [(r.facility_id, r.restaurant_name, r.score, r.zip_code, r.created_at) for r in rows] == [
        ("77", 'Blue "Owl" Cafe', 95, "78701", None), ("78", "Red Fox", None, "78702", None)]
    assert tables.read_export(spark, str(path)).filter("facility_id = '77'").first().zip5 == "78701"
    short = tmp_path / "short.csv"
    short.write_text("facility_id,score\n1,2\n")
    with pytest.raises(ValueError, match="columns missing"):
        tables.read_table(spark, str(short), schemas.RAW_EXPORT, "csv")


def test_no_window_when_up_to_date(spark):
    from recordlens.operators.fetch import window_plan

    bounds = spark.sql("SELECT date'2026-01-05' AS s, date'2026-01-04' AS e")
    assert window_plan(bounds, "s", "e").count() == 0


def test_nested_values_give_their_first_element(spark):
    from recordlens.sources.pages import classify_pages, page_records

    body = '[{"inspectionID": ["a", "b"], "score": [], "city": "[x", "zip": {"k": 1}}]'
    pages = spark.createDataFrame([("w", 0, body)], "window string, start int, body string")
    row = page_records(classify_pages(pages)).first()
    assert (row.inspectionID, row.score, row.city, row.zip) == ("a", None, "[x", '{"k":1}')


def test_bronze_is_empty_before_the_first_batch(spark, tmp_path):
    from recordlens.streaming.ingest import FAULTS, LOG, RECORDS, current_records, read_bronze

    for name in (RECORDS, LOG, FAULTS):
        assert read_bronze(spark, str(tmp_path / "none"), name).count() == 0
    assert current_records(spark, str(tmp_path / "none")).count() == 0
