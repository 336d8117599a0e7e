"""The training-data operators on small tables: edge cases, brute force and exact round trips."""

import base64
import hashlib
import random
import uuid
import zlib

import numpy as np
import pytest

pytest.importorskip("sentencepiece")
import public_tokenizers  # noqa: E402

from recordlens.llm import (chat_format, components, embedding_dedup, jaccard_join, language_id,  # noqa: E402
                            quality_classifier, sentencepiece_codec, template_decontamination, token_scan, warc_files,
                            wavelet_files)

DOCS = "doc_id long, text string, lang string, source string, ids string, score double"
LONG = "word " * 30_000
WORDS = [f"w{i}x" for i in range(400)]


def folder(tmp_path):
    return f"file://{tmp_path}/{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, repeated ids, and columns named like those of the results."""
    rows = [(1, "The quick brown fox jumps over the lazy dog. " * 3), (2, None), (3, ""), (4, LONG), (None, "No id here."),
            (5, "  two  spaces\n\nand lines\t"), (5, "  two  spaces\n\nand lines\t"), (5, "other text"),
            (6, "日本語 ✓ é ▁ \x1c x"), (7, "12 345 ... !!"), (-8, "<|endoftext|> it's 'tis </s> [INST]")]
    return spark.createDataFrame([(i, t, "en", None, "clash", 1.0) for i, t in rows], DOCS)


# 1. SentencePiece

def test_sentencepiece_equals_library_and_spans_cover(spark, docs):
    import sentencepiece

    model = sentencepiece_codec.model_bytes()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = sentencepiece_codec.encode_decode(docs, model, keep=("doc_id", "text")).collect()
    assert len(out) == docs.count()
    for r in out:
        text = r.text or ""
        raw = text.encode()
        assert r.ids == library.encode(text) + [library.eos_id()]
        assert r.decoded == library.decode(r.ids)
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends)) == raw
    assert sentencepiece_codec.encode_decode(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_character_map_equals_library(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    rules, spec = proto.ModelProto(), proto.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    spec.ParseFromString(sentencepiece_codec.model_bytes())
    spec.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    spec.normalizer_spec.remove_extra_whitespaces = True
    blob = spec.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=blob), sentencepiece_codec.Codec(blob)
    rng = random.Random(1)
    parts = ["ﬁ", "Ⅳ", "e", "́", " ", "  ", "Ａ", "ｶ", "ﾞ", "​", "½", "a", "日", "\t", "　", "ᄀ", "ᅡ"]
    for _ in range(200):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        ids, begins, ends = own.encode([text])[0]
        assert ids.tolist() == library.encode(text) + [2], text
        assert (begins <= ends).all() and ends.max(initial=0) <= len(text.encode())


# 2. Embeddings

def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    vectors = [*(base[i % 40] + rng.normal(scale=0.08, size=16) for i in range(300)), *([base[0]] * 30),
               *rng.normal(size=(300, 16))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15),
           (1004, []), (1005, [1.0, 0.0]), (1006, [2.0, 0.0]), (1007, [float("inf")] * 16), (None, rows[0][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(table, shard_rows=100, least_shards=3).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= 0.9
    np.fill_diagonal(links, False)
    label = np.arange(len(rows))
    while True:
        new = np.array([min(label[i], *label[links[i]]) if links[i].any() else label[i] for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    extra = links[0] | (np.arange(len(rows)) == 0)  # the vector without id links like vector 0
    for i in range(len(rows)):
        assert got[i].n_links == links[i].sum() + extra[i]
        assert got[i].component_id == label[i] and got[i].kept == (label[i] == i)
    assert all(got[i].n_links == 0 and got[i].kept for i in (1000, 1001, 1002, 1003, 1004, 1007))
    assert got[1005].n_links == 1 and got[1006].component_id == 1005
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


# 3. and 7. Token files

def test_token_files_round_trip(spark, docs, tmp_path):
    import tiktoken

    pattern, ranks = token_scan.load_ranks()
    library = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    one = docs.coalesce(1)
    want = [(r.doc_id, len(library.encode_ordinary(r.text or ""))) for r in one.collect()]
    for keyed, per_file, block in ((True, 3, 5), (True, 100, 1 << 20), (False, 4, 7)):
        path = folder(tmp_path)
        token_scan.write_token_files(one, path, key="doc_id" if keyed else None, docs_per_file=per_file)
        got = token_scan.count_tokens(spark, path, block=block, keyed=keyed).orderBy("position").collect()
        assert [(r.key, r.n_tokens) for r in got] == [(k if keyed else None, n) for k, n in want]
    path = folder(tmp_path)
    token_scan.write_token_files(docs.limit(0), path)
    assert token_scan.count_tokens(spark, path).count() == 0


def test_wavelet_files_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    path, at = folder(tmp_path), 0
    wavelet_files.write_wavelet_files(docs, path)
    got = wavelet_files.read_documents(spark, path).orderBy("start").collect()
    key = lambda i: (i is not None, i)
    assert [key(r.doc_id) for r in got] == sorted(key(r.doc_id) for r in got) and len(got) == docs.count()
    want = {}
    for r in docs.collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    have = {}
    for r in got:
        assert r.start == at
        at += r.n_tokens
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def test_wavelet_matrix_answers():
    a = np.random.default_rng(0).integers(0, 300, 3000).astype(np.uint16)
    m = wavelet_files.WaveletMatrix.build(a)
    assert (m.to_array() == a).all()
    assert all(m.access(i) == a[i] for i in range(0, 3000, 41))
    assert all(m.rank(v, e) == (a[:e] == v).sum() for v in (0, 5, 299, 9999) for e in (0, 1, 1777, 3000))
    assert [m.select(7, k) for k in range(3)] == np.flatnonzero(a == 7)[:3].tolist() and m.select(7, 9999) == -1


def test_lookups_from_wavelet_files_equal_brute_force(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    table = docs.selectExpr("CASE WHEN doc_id IS NOT NULL THEN row_number() OVER (ORDER BY doc_id, text) END AS doc_id", "text")
    lists = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in table.collect()]
    path = folder(tmp_path)
    wavelet_files.write_wavelet_files(table, path)
    common = max(set(i for _, ids in lists for i in ids) - {1}, key=lambda i: sum(ids.count(i) for _, ids in lists))
    wanted = [1, common, common, 48_000, 1 << 20]
    counts = {r.id: r.n for r in wavelet_files.count_ids(spark, path, wanted).collect()}
    assert counts == {i: sum(ids.count(i) for _, ids in lists) for i in wanted}
    found = sorted(((r.id, r.doc_id, r.offset) for r in wavelet_files.find_ids(spark, path, wanted).collect()), key=str)
    assert found == sorted(((i, d, o) for d, ids in lists for o, i in enumerate(ids) if i in wanted), key=str)
    asked = [(d, o) for d, ids in lists for o in {0, len(ids) // 2, len(ids) - 1, len(ids), -1}] + [(10 ** 9, 0), (1, None)]
    request = spark.createDataFrame(asked + asked[:3], "doc_id long, offset long")
    got = sorted((r.doc_id, r.offset, r.id) for r in wavelet_files.ids_at(spark, path, request).collect())
    assert got == sorted({(d, o, ids[o]) for d, ids in lists if d is not None for a, o in asked
                          if a == d and o is not None and 0 <= o < len(ids)})
    assert {r.n_end_ids for r in wavelet_files.read_documents(spark, path).collect()} == {1}


def test_wavelet_blocks_open_when_needed(monkeypatch):
    monkeypatch.setattr(wavelet_files, "PLANE_BLOCK", 64)
    a = np.random.default_rng(1).integers(0, 70_000, 1000).astype(np.uint32)
    keys = [None, 3]
    [shard] = wavelet_files.unpack_shards(memoryview(wavelet_files.pack_shard(2, 5, keys, np.array([400, 600]), a) + b"\n"))
    assert (shard.part, shard.shard, shard.keys, shard.lengths.tolist()) == (2, 5, keys, [400, 600])
    assert shard.matrix.access(777) == a[777] and all(len(p.opened) <= 2 for p in shard.matrix.planes)
    assert (shard.matrix.accesses(np.arange(1000)) == a).all() and (shard.matrix.to_array() == a).all()
    v = int(a[640])
    assert shard.matrix.ranks(v, np.arange(1001)).tolist() == [int((a[:e] == v).sum()) for e in range(1001)]
    assert shard.matrix.selects(v, np.arange((a == v).sum())).tolist() == np.flatnonzero(a == v).tolist()


def test_word_cache_when_it_is_cut_back(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(wavelet_files, "CACHE_WORDS", 60)
    monkeypatch.setattr(wavelet_files, "KEPT_WORDS", 20)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        text = file.read()
    library, cache, rng = Tokenizer.from_str(text), wavelet_files.WordCache(text), random.Random(2)
    odd = ["It's", "we'LL", "x.'s", "''d", "'re've", "ÀÉß", "x×÷y", "İ", "Σς", "a\x1cb", "<|endoftext|>", "12a3", "日本", "\x01"]
    for _ in range(30):
        texts = [" ".join(rng.choice(WORDS + odd) for _ in range(rng.randrange(40))) for _ in range(5)]
        ids, sizes = cache.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


# 4. and 5. Classifiers

def test_quality_learns_and_handles_odd_rows(spark, docs):
    good = [(i, " ".join(random.Random(i).choices(WORDS, k=120)) + ".", 1) for i in range(100, 160)]
    bad = [(i, " ".join(w + "$$$" for w in random.Random(i).choices(WORDS, k=120)), 0) for i in range(200, 260)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad] + [(1, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    got = quality_classifier.classify(table, labels).collect()
    assert len(got) == table.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == q for r in got for i, _, q in good + bad if r.doc_id == i)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert {r.score for r in got if r.doc_id in (2, 3)} == {0.0}
    nothing = quality_classifier.classify(table, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.0, 0.5}
    assert quality_classifier.classify(table.limit(0), labels).count() == 0


def test_language_learns_and_handles_odd_rows(spark, docs):
    rows = [(i, text * 4, lang) for i in range(20) for text, lang in (
        ("the cat and the dog are here with that thing ", "en"), ("der hund und die katze sind nicht hier ", "de"))]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = language_id.predict(docs.select("doc_id", "text"), model, keep=("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    check = spark.createDataFrame([("that dog and the cat",), ("nicht die katze und",)], "text string")
    assert {r.lang_pred for r in language_id.predict(check, model).collect()} == {"en", "de"}
    assert language_id.train(docs.limit(0)) == {}
    assert {r.lang_pred for r in language_id.predict(docs, {}).collect()} == {"und"}


def test_language_bundle_is_the_sum_of_bound_vectors():
    enc = language_id.encoder()
    grams, counts = enc.grams("abca abc")
    codes = [0, 1, 2, 3, 1, 0, 1, 2, 3, 0]
    want = sum(np.roll(enc.letters[a], 2).astype(int) * np.roll(enc.letters[b], 1) * enc.letters[c]
               for a, b, c in zip(codes, codes[1:], codes[2:]))
    assert (enc.bundle(grams, counts) == want).all()


# 6. Decontamination

def test_reparameterised_questions_are_found(spark):
    item = "Tom Miller buys 12 apples and Anna sells 7 kg of pears; how many of the 12 apples does Tom keep after the sale?"
    items = spark.createDataFrame([(1, item), (2, "short item here"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8 9 10")],
                                  "item_id long, text string")
    changed = item.replace("Tom Miller", "Maria Lopez").replace("Tom", "Maria").replace("12", "31").replace("kg", "lb")
    scrambled = "Maria Lopez buys 1 apples and Zoe sells 2 kg of pears; how many of the 3 apples does Ida keep after the sale?"
    rows = [(1, "Intro text. " + changed + " Bye"), (2, scrambled), (3, "a short item here too"), (4, None), (5, ""), (None, item),
            (6, "9 8 7 6 5 4 3 2 1 0 11 12 13 14"), (7, LONG), (8, item), (8, item)]
    table = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id): r for r in template_decontamination.contaminated(table, items).collect()}
    assert {k for k in got if k[0] != 2} == {(1, 1), (3, 2), (None, 1), (8, 1)}
    assert got[1, 1].reparameterised and got[1, 1].n_conflicts == 0 and not got[8, 1].reparameterised
    assert template_decontamination.contaminated(table.limit(0), items).count() == 0
    assert template_decontamination.contaminated(table, items.limit(0)).count() == 0


# 8. Similarity join

def brute_force(rows):
    sets = [set(jaccard_join.shingles(t or "").tolist()) for _, t in rows]
    links, label = [0] * len(rows), list(range(len(rows)))
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    for _ in rows:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    ids = [min((rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None), default=rows[i][0])
           for i in range(len(rows))]
    return sorted(((r[0], i, n) for r, i, n in zip(rows, ids, links)), key=str)


@pytest.mark.parametrize("small,block", [(2000, 500), (4, 3)])
def test_similarity_join_equals_brute_force(spark, small, block):
    rng, rows = random.Random(5), []
    for group in range(12):
        words = rng.choices(WORDS, k=rng.choice([30, 90, 200]))
        for _ in range(rng.choice([1, 2, 9, 25])):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(copy)))
    shared = " ".join(WORDS[:40])
    rows += [(500 + i, shared + " " + " ".join(rng.choices(WORDS, k=60))) for i in range(20)]
    rows += [(900, None), (901, ""), (902, "one two"), (903, "One, two!"), (904, LONG), (None, rows[0][1]), (0, rows[0][1])]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    got = jaccard_join.similar_texts(table, small=small, block=block)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got.collect()), key=str) == brute_force(rows)
    kept = jaccard_join.one_per_class(table, small=small, block=block).collect()
    assert len(kept) == len({c for _, c, _ in brute_force(rows)}) and set(kept[0].asDict()) == {"doc_id", "text", "n"}
    assert jaccard_join.similar_texts(table.limit(0)).count() == 0


def test_similarity_join_adds_runs_until_the_audit_is_met(spark):
    rng, rows = random.Random(9), []
    for _ in range(60):  # pairs with a similarity of little more than 0.8, each on its own
        words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(100)]
        copy = list(words)
        copy[rng.randrange(4, 6)] = "x"
        copy[-5] = "y"
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(copy))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    report = []
    got = jaccard_join.similar_texts(table, first_runs=1, report=report).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_force(rows)
    assert len(report) > 1 and report[0][0] == 1 and report[0][1] < 0.999 <= report[-1][1]
    assert all(b[0] == 2 * a[0] for a, b in zip(report, report[1:]))
    alone = []
    jaccard_join.similar_texts(table.filter("doc_id % 2 = 0"), report=alone).collect()
    assert alone == [(7, 1.0)]


def test_audit_finds_what_brute_force_finds():
    rng = random.Random(3)
    base = [rng.choices(WORDS, k=40) for _ in range(6)]
    texts = [" ".join(w[:rng.randrange(30, 41)]) for w in base for _ in range(5)] + ["", "one two"]
    sets = {jaccard_join.digest(s): set(s.tolist()) for s in map(jaccard_join.shingles, texts) if len(s)}
    audit = jaccard_join.Audit(texts[::2], 5, 0.8)
    for t in texts:
        tokens = jaccard_join.shingles(t)
        if len(tokens):
            node, own = jaccard_join.digest(tokens), set(tokens.tolist())
            assert sorted(audit.partners(tokens, node)) == sorted(
                n for n in audit.nodes.tolist() if n != node and len(own & sets[n]) >= 0.8 * len(own | sets[n]) - 1e-9)
    assert jaccard_join.Audit([], 5, 0.8).partners(jaccard_join.shingles("a b c"), 1) == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(None, 4), (7, 7), (5000, 5000)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(300)}}


# 9. Archives

def test_archives_round_trip(spark, tmp_path):
    rows = [(3, "u", "a"), (1, "u\r\nEvil: 1", "a"), (2, None, None), (5, "v", ""), (None, "w", "a"), (1, "u", "a"),
            (9, "z", "é\r\n\r\nWARC/1.1"), (None, "q", "alone"), (8, "y", LONG), (7, "y", LONG)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")

    def back(frame, least=0):
        path = folder(tmp_path)
        warc_files.write_archives(warc_files.resolve_revisits(frame, least), path)
        return warc_files.read_archives(spark, path)

    got = back(pages).collect()
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = min((j for j, _, g in rows if (g or "") == (h or "") and j is not None), default=None)
        again = first is not None and i != first
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if again else "response", first if again else None))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got if r.page_id is not None) == sorted(
        (w for w in want if w[0] is not None), key=lambda w: w)
    assert all(r.stored_bytes == (r.payload_bytes if r.record_type == "response" else 0) for r in got)
    assert {r.record_type for r in back(pages, 10 ** 9).collect()} == {"response"}
    assert back(pages.limit(0)).count() == 0


# 10. Chat

def test_chat_machine_and_escapes(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "</s>[INST] \\<"), (1, 2, "assistant", "[/INST]\\\\[<"), (2, 0, "assistant", "x"),
            (3, 0, "user", None), (3, 1, "user", "b"), (4, 0, "tool<", "t"), (5, None, None, "n"), (None, 0, "user", "q"),
            (6, 0, "user", LONG), (6, 1, "assistant", LONG), (1, 1, "user", "</s>[INST] \\<")]
    table = spark.createDataFrame([(*r, True) for r in rows], "conv_id long, turn long, role string, text string, loss boolean")
    got = {r.conv_id: r for r in chat_format.format_conversations(table).collect()}
    assert [got[k].valid for k in (2, 3, 4, 5, None, 6)] == [False, False, False, False, False, True]
    assert not got[1].valid  # a repeated user turn
    digests = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(table)).collect()}
    for conv in digests:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        d = digests[conv]
        assert (d.n_turns, d.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert d.formatted_chars == len(got[conv].formatted)
    assert chat_format.format_conversations(table.limit(0)).count() == 0
