"""The two learned operators against plain versions: one covariance of all labelled rows, letter vectors term by term."""

import zlib
from collections import Counter

import numpy as np
import pytest

from recordlens.llm import language_id, quality_classifier

GOOD = "The committee met in spring and wrote a careful report about water, schools and roads. It was read by many people. "
BAD = "BUY NOW!!! click click click $$$ 99 99 www win win !!! FREE "


def texts(n):
    rng = np.random.default_rng(12)
    out = []
    for i in range(n):
        base = (GOOD if i % 2 else BAD).split()
        rng.shuffle(base)
        out.append(" ".join(base[:int(rng.integers(4, 20))]))
    return out


def tables(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(160))] + [(500, None), (501, ""), (502, "..."), (None, GOOD), (3, BAD), (3, BAD)]
    labels = [(i, i % 2) for i in range(160) if i % 3] + [(5, None), (7, 2), (9999, 1), (4, 0), (4, 0), (None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    return rows, labels


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_quality_scores_equal_a_plain_discriminant(spark, tmp_path):
    rows, labels = tables(spark, tmp_path)
    learned = [(np.array(quality_classifier.statistics(t or "")), q) for i, t in rows for j, q in labels
               if i is not None and i == j and q in (0, 1) and fold(i, 5) != 0]
    x, y = np.array([s for s, _ in learned]), np.array([q for _, q in learned])
    d = x.shape[1]
    parts = [x[y == c] for c in (0, 1)]
    scatter = [(p - p.mean(0)).T @ (p - p.mean(0)) for p in parts]
    pooled = sum(scatter) / (len(x) - 2)
    logs = []
    for p, s in zip(parts, scatter):
        own = s / (len(p) - 1) if len(p) >= quality_classifier.MIN_CLASS_ROWS else pooled
        mixed = (1 - quality_classifier.SHRINK_POOLED) * own + quality_classifier.SHRINK_POOLED * pooled
        mixed = (1 - quality_classifier.SHRINK_SPHERE) * mixed + quality_classifier.SHRINK_SPHERE * max(np.trace(mixed) / d, 1e-6) * np.eye(d)
        inverse, (_, det) = np.linalg.inv(mixed), np.linalg.slogdet(mixed)
        logs.append(lambda v, m=p.mean(0), inverse=inverse, det=det, n=len(p): (
            np.log(n / len(x)) - 0.5 * det - 0.5 * (v - m) @ inverse @ (v - m)))
    got = quality_classifier.op4_quality_qda(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        v = np.array(quality_classifier.statistics(t or ""))
        score = 1 / (1 + np.exp(np.clip(logs[0](v) - logs[1](v), -700, 700))) if (t or "").strip() else 0.0
        want.setdefault(i, []).append(score)
    for r in got:
        assert min(abs(r.score - w) for w in want[r.doc_id]) < 1e-3
        assert r.held_out == (fold(r.doc_id, 5) == 0)
        assert r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 160 and r.held_out]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.9


def letter_vectors():
    return np.random.default_rng(language_id.SEED).choice(
        np.array([-1, 1], np.int8), (language_id.CODES, language_id.DIMENSION)).astype(int)


def plain_vector(text, letters):
    """The bundle of a text: one bound vector per trigram, added one by one."""
    codes = [0]
    for c in text:
        code = language_id.letter_code(ord(c))
        if code or codes[-1]:
            codes.append(code)
    if codes[-1]:
        codes.append(0)
    total = np.zeros(language_id.DIMENSION)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return total


def test_language_scores_equal_vectors_built_term_by_term(spark, tmp_path):
    samples = {"en": ["the cat sat on the mat", "where is the old dog now", "They went to the sea."],
               "de": ["der hund und die katze", "wo ist das alte haus jetzt", "Sie fuhren ans Meer."],
               "fr": ["le chat et la souris", "où est la vieille maison", "Ils sont allés à la mer."]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((k, t) for k, v in samples.items() for t in v * 4)]
    rows += [(100, None, "en"), (101, "123 ...", None), (102, "the house", None), (103, "ß", "de"), (None, "le chien", "fr"), (0, "x y", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    letters = letter_vectors()
    sums: dict[str, np.ndarray] = {}
    for i, t, lang in rows:
        if lang is not None and fold(i, 4) != 2:
            sums[lang] = sums.get(lang, 0) + plain_vector(t or "", letters)
    prototypes = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    got = language_id.op5_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want: dict[tuple, Counter] = {}
    for i, t, _ in rows:
        v = plain_vector(t or "", letters)
        if not any(language_id.letter_code(ord(c)) for c in t or ""):
            answer = ("und", 0.0)
        else:
            scores = {k: float(p @ v / np.linalg.norm(v)) for k, p in prototypes.items()}
            best = max(sorted(scores), key=scores.get)
            answer = (best, round(min(max(scores[best], 0), 1), 4))
        want.setdefault(i, Counter())[answer] += 1
    have: dict[tuple, Counter] = {}
    for r in got:
        have.setdefault(r.doc_id, Counter())[r.lang_pred, round(r.score, 4)] += 1
        assert r.held_out == (fold(r.doc_id, 4) == 2)
    for i, answers in want.items():
        for (lang, score), n in answers.items():
            assert sum(m for (k, s), m in have[i].items() if k == lang and abs(s - score) < 2e-4) >= n


@pytest.mark.parametrize("labels", ["", "one class"])
def test_quality_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, GOOD), (2, "")], "doc_id long, text string")
    known = spark.createDataFrame([(1, 1)] if labels else [], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_classifier.classify(docs, known).collect()}
    assert got == {1: 0.5, 2: 0.0}
