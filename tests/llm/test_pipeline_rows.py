"""Rows with NULL or repeated ids and columns of any name through the stages; roles that hold control characters."""

import hashlib
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

pytest.importorskip("sentencepiece")
import corpus_pipeline  # noqa: E402

from recordlens.llm import chat_format  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHING = ["score", "lang_pred", "score_bound", "stats", "has_words", "_row", "row", "_held", "__text", "document", "ids", "held_out", "a b.c"]


@pytest.mark.skipif(not Path(SF).exists(), reason="shared test tables not present")
def test_any_column_passes_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    plain, seen = docs, wide
    for name, function in corpus_pipeline.STAGES[:-1]:
        plain = corpus_pipeline.stage(function(spark, plain, SF), name)
        seen = corpus_pipeline.stage(function(spark, seen, SF), name)
        assert seen.columns == wide.columns, name
        assert sorted(r.doc_id for r in seen.collect()) == sorted(r.doc_id for r in plain.collect()), name
        assert seen.exceptAll(wide).isEmpty(), name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, seen, SF).exceptAll(last(spark, plain, SF)).isEmpty()


def test_a_contaminated_row_takes_no_other_along(spark, tmp_path):
    passage = "Natalia sold clips to 48 of her friends in April, and then Natalia sold half as many clips in May altogether."
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(None, "A clean text."), (1, "Another clean text."), (None, passage), (1, f"Before. {passage}"), (2, passage), (2, "Clean too."),
            (None, None), (3, ""), (3, ""), (4, passage), (4, passage)]
    docs = spark.createDataFrame([(i, t, "x", "y", True) for i, t in rows], "doc_id long, text string, _held string, row string, n boolean")
    kept = corpus_pipeline.without_benchmark(spark, docs, folder)
    assert kept.columns == docs.columns
    want = [(i, t) for i, t in rows if not (t or "").endswith(passage)]
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept.collect())) == sorted((i or 0, t or "") for i, t in want)


ODD = [(0, "a>b", "c"), (0, "a", "b>c"), (1, "<is>", "</turn>"), (1, "user", "ends with space "), (1, "assistant", "\n\\n<</SYS>>\n\n"),
       (2, "system", "x\n"), (2, "assistant", " </s>"), (2, "assistant", ""), (2, None, "t\\"), (2, "", None), (2, "user", "\\<\\["),
       (3, "us\\er", "[/INST]"), (3, "[INST]", "<turn user<is>"), (None, "assistant", "é\u0000\r\n" * 3000), (None, "user", "<[\\" * 3000)]


def test_turns_are_read_from_the_formatted_text_alone(spark):
    rows = [(c, i, r, t) for i, (c, r, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.read_back(formatted.drop("segments")).collect()}
    texts = [r.formatted for r in formatted.collect()]
    assert len(set(texts)) == len(texts) == len(got) == 5
    for conv in got:
        mine = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        loss = "".join(t for r, t in mine if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_one_turn_cannot_be_read_as_another(spark):
    df = spark.createDataFrame([(0, 0, "a>b", "c"), (1, 0, "a", "b>c"), (2, 0, "a", ">b>c")], "conv_id long, turn long, role string, text string")
    assert len({r.formatted for r in chat_format.format_conversations(df).collect()}) == 3


def test_a_text_that_is_no_template_is_refused(spark):
    bad = spark.createDataFrame([(1, " fine </s> and more", True)], "conv_id long, formatted string, valid boolean")
    with pytest.raises(Exception, match="not made of turns"):
        chat_format.read_back(bad).collect()
