"""Snapshots with upserts, and the log of window states: replays, untouched files, lost races."""

import random
from pathlib import Path

import pytest
from recordlens.schemas import _schema

from recordlens.sources import commits
from recordlens.sources.snapshots import Snapshots
from recordlens.sources.state_log import StateLog

RECORD = _schema("id string, stamp string, value int")


def frame(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def files(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("part-*")}


def state(store, spark):
    return sorted((tuple(r) for r in store.read(spark).collect()), key=str)


def newest(rows):
    found = {}
    for r in rows:
        if r[0] not in found or (r[1], -r[2]) > (found[r[0]][1], -found[r[0]][2]):
            found[r[0]] = r
    return sorted(found.values(), key=str)


def test_upserts_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    store = Snapshots(str(tmp_path / "t"), RECORD, "id", "stamp", ["value"], buckets=8)
    assert state(store, spark) == []
    seen, before = [], 0
    for batch in range(4):
        rows = [(rng.choice([None, *(f"k{i}" for i in range(40))]), f"2024-0{rng.randrange(1, 9)}", rng.randrange(3)) for _ in range(30)]
        had = {r[0]: r for r in newest(seen)}
        seen += rows
        want = newest(seen)
        got = store.upsert(frame(spark, rows)).first()
        assert state(store, spark) == want
        now = {r[0]: r for r in want}
        updated = sum(k in had and had[k] != r for k, r in now.items())
        assert (got.version, got.n_before, got.n_incoming, got.n_after) == (batch + 1, before, 30, len(want))
        assert (got.n_new, got.n_updated, got.n_unchanged) == (len(now) - len(had), updated, len(had) - updated)
        before = len(want)
        held = files(tmp_path)
        replay = store.upsert(frame(spark, rows)).first()
        assert (replay.version, replay.n_new, replay.n_updated, replay.buckets_rewritten) == (batch + 1, 0, 0, 0)
        assert files(tmp_path) == held


def test_untouched_buckets_keep_their_files_and_readers_their_snapshot(spark, tmp_path):
    store = Snapshots(str(tmp_path / "t"), RECORD, "id", "stamp", ["value"], buckets=16)
    store.upsert(frame(spark, [(f"k{i}", "1", i) for i in range(200)]))
    first = store.manifest(spark)
    got = store.upsert(frame(spark, [("k7", "2", 0), ("k8", "0", 0)])).first()
    second = store.manifest(spark)
    assert (got.n_updated, got.n_new, got.buckets_rewritten) == (1, 0, 1)
    assert sum(first["folders"][b] != second["folders"][b] for b in first["folders"]) == 1
    assert ("k7", "1", 7) in {tuple(r) for r in store.read(spark, first).collect()}
    assert ("k7", "2", 0) in {tuple(r) for r in store.read(spark, second).collect()}
    assert store.upsert(frame(spark, [])).first().version == 2


def test_a_lost_race_publishes_nothing(spark, tmp_path, monkeypatch):
    store = Snapshots(str(tmp_path / "t"), RECORD, "id", "stamp", ["value"], buckets=4)
    store.upsert(frame(spark, [("a", "1", 1)]))
    stale = store.manifest(spark)
    store.upsert(frame(spark, [("b", "1", 1)]))
    monkeypatch.setattr(Snapshots, "manifest", lambda self, spark, version=None: stale)
    with pytest.raises(commits.LostRace):
        store.upsert(frame(spark, [("c", "1", 1)]))
    monkeypatch.undo()
    assert [r[0] for r in state(store, spark)] == ["a", "b"]
    assert not [p for p in Path(tmp_path / "t" / "manifests").iterdir() if p.name.startswith("_")]


def test_the_state_log_folds_and_reports_a_lost_race(spark, tmp_path):
    schema = _schema("key string, state string, n int")
    log = StateLog(str(tmp_path / "log"), schema, "key")
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    assert log.states(spark).isEmpty() and log.version(spark) == 0
    assert log.commit(rows(("a", "planned", 0), ("b", "planned", 0)), 0) == 1
    assert log.commit(rows(("a", "done", 5), ("b", "planned", 0)), 1) == 2
    assert {tuple(r) for r in log.states(spark).collect()} == {("a", "done", 5, 2), ("b", "planned", 0, 1)}
    assert log.history(spark).count() == 3
    assert log.commit(rows(("a", "done", 5)), 2) == 2
    with pytest.raises(commits.LostRace):
        log.commit(rows(("b", "failed", 0)), 1)
    assert {tuple(r) for r in log.states(spark, 1).collect()} == {("a", "planned", 0, 1), ("b", "planned", 0, 1)}
    with pytest.raises(commits.LostRace):
        commits.publish(spark, f"{log.root}/commits", 2, {"path": "other"})
    assert log.commit(rows(("b", "failed", None)), 2) == 3
    assert {tuple(r) for r in log.states(spark).collect()} == {("a", "done", 5, 2), ("b", "failed", None, 3)}
