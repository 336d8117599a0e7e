"""Rows and pairs that a cut, a bound or a noisy estimate once lost."""

from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("sentencepiece")
import corpus_pipeline  # noqa: E402

from recordlens.llm import embedding_dedup, language_id, template_decontamination  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="shared test tables not present")
def test_short_texts_stay_and_long_texts_like_no_language_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(5)
    short = ["Pas.", "Avec.", "A.", "Es be.", "Shea by from.", "Oui.", "Zug.", "Ojo.", "Why?", "Jaja.", "Wozu?", "Byte."]
    junk = ["".join(rng.choice(list("qxzjkvwpy"), 300)) for _ in range(40)]
    extra = spark.createDataFrame([(10_000_000 + i, t, None) for i, t in enumerate(short + junk)],
                                  "doc_id long, text string, lang string")
    kept = corpus_pipeline.known_language(spark, docs.unionByName(extra), SF)
    got = {r.text for r in kept.filter("doc_id >= 10000000").collect()}
    assert got == set(short)


def test_language_bundles_equal_single_ones():
    enc = language_id.encoder()
    profiles = [enc.grams(t) for t in ["the cat", "the dog and the cat", "der hund", "x" * 50, "once only"] * 3 + ["rare öäü"]]
    assert (enc.bundles(profiles) == np.array([enc.bundle(*p) for p in profiles])).all()
    assert enc.bundles([]).shape == (0, language_id.DIMENSION)


def found(spark, items, texts):
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in template_decontamination.contaminated(docs, items).collect()}


def test_items_of_numbers_match_by_their_literal_tokens(spark):
    items = ["Compute 12 + 7 * 3 - 4 / 2", "What is 12 + 7 + 33 + 41 + 5 + 8 + 9 + 10 + 4 + 77 + 6 + 15?", "42"]
    texts = [*items[:2], "It was 42 then.", "There are 17 of them.", "Compute 1 + 2 * 3 - 5 / 6",
             "What is 1 + 2 + 3 + 4 + 55 + 66 + 77 + 88 + 99 + 11 + 22 + 13?"]
    assert found(spark, items, texts) == {(0, 0), (1, 1), (2, 2)}


def test_case_and_line_breaks_do_not_hide_a_passage(spark):
    item = ("Natalia sold clips to 48 of her friends in April, and then Natalia sold half as many clips in May. "
            "How many clips did Natalia sell altogether in April and May?")
    wrapped = item[0] + item[1:].replace(" Natalia", "\nNatalia").replace(" April", " \n\tApril").replace(" May", "\u00a0May")
    texts = [item, item.lower(), item.upper(), wrapped, "Something else that was sold to friends in April and in May."]
    assert found(spark, [item], texts) == {(0, 0), (1, 0), (2, 0), (3, 0)}


def test_names_at_the_start_of_a_sentence_are_slots(spark):
    item = "Natalia met Tom and Natalia left. Tom ran to Natalia and back. Natalia saw Tom run. Tom saw it too."
    changed = item.replace("Natalia", "Maria").replace("Tom", "Leo")
    assert found(spark, [item], [item, changed]) == {(0, 0), (1, 0)}


def audited_graph(monkeypatch):
    """A dense group of 400 nodes and 200 lone pairs, and a search that loses the lone ones at the first beam."""
    rng = np.random.default_rng(1)
    lone = rng.normal(size=(200, 64))
    hot = rng.normal(size=64) + rng.normal(scale=0.01, size=(400, 64))
    graph = embedding_dedup.Graph(np.concatenate([hot, lone]))
    search = graph._within

    def within(q, least, beam, skip):
        found, nearest = search(q, least, beam, skip)
        if beam > embedding_dedup.BEAM:
            return found, nearest
        return [f[f < 400] for f in found], np.where(nearest < 400, nearest, -1)

    monkeypatch.setattr(graph, "_within", within)
    return graph


def test_a_dense_group_does_not_outvote_lone_pairs(monkeypatch):
    graph = audited_graph(monkeypatch)
    q = np.concatenate([graph.exact[:200], graph.exact[400:]])
    assert all(len(f) for f in graph.search(q, 0.9))


def test_audited_queries_without_links_still_tell(monkeypatch):
    graph = audited_graph(monkeypatch)
    q = np.random.default_rng(2).normal(size=(64, 64))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    q[1] = graph.exact[450]
    assert graph.search(q, 0.9)[1].tolist() == [450]
    assert graph.beam > embedding_dedup.BEAM and graph.brute_blocks == 0


@pytest.mark.parametrize("kind", ["sparse", "paired", "hot"])
def test_graphs_answer_and_miss_few_links(kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 48))
    if kind == "paired":
        x[1500:] = x[:1500] + rng.normal(scale=0.12, size=(1500, 48))
    if kind == "hot":
        x[:1000] = x[0] + rng.normal(scale=0.1, size=(1000, 48))
    rng.shuffle(x)
    graph = embedding_dedup.Graph(x[:2500])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = [f for at in range(0, 3000, 512) for f in graph.search(unit[at:at + 512], 0.9)]
    truth = unit @ graph.exact.T >= 0.9
    assert graph.brute_blocks == 0 and graph.beam < 2500
    assert sum(len(f) for f in found) >= 0.99 * truth.sum()
    assert all(set(f.tolist()) <= set(np.flatnonzero(t).tolist()) for f, t in zip(found, truth))
    small = embedding_dedup.Graph(x[:100])
    small.search(small.exact, 0.9)
    assert small.brute_blocks == 1


def test_pairs_count_at_both_ends_and_dense_counts_stand(spark):
    rows = [(0, "pair", 1, 2, 1, 5), (0, "pair", 2, 1, 5, 1), (0, "pair", 1, 3, 1, 2), (0, "many", 4, None, None, 70),
            (0, "pair", 5, 4, 3, 9), (0, "edge", 4, 6, None, None)]
    found = spark.createDataFrame(rows, embedding_dedup.FOUND)
    got = {r.rep: r.links for r in embedding_dedup.link_counts(found, 1).collect()}
    assert got == {1: 7, 2: 1, 3: 1, 4: 70, 5: 9}
