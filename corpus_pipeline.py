"""From raw documents to encoded ones: language, quality, near copies, benchmark passages, tokens.

Stages but the last return the columns of their input, whatever else it has besides id, text and language: an added column
may bear any name. A row is judged by its own id and text, so rows with NULL or repeated ids stay or go each by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm import jaccard_join, language_id, quality_classifier, sentencepiece_codec, template_decontamination
from recordlens.llm.common import fold, packed, stage, unpacked

LEAST_LANGUAGE_SCORE = 0.05  # cosine below which a text is like no language, if it is long enough to tell
LEAST_QUALITY = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without letters and texts that are like no language.

    A text is like none if its score is below ``LEAST_LANGUAGE_SCORE`` and also below what a text with as many
    n-grams of a learned language would reach: a short text stays unless its n-grams speak against it.
    """
    prototypes = language_id.train(docs.filter(fold("doc_id", 4) != 2))
    judged = language_id.predict(packed(docs), prototypes, keep=("document",), keep_text=True)
    known = (F.col("lang_pred") != "und") & (
        F.col("score") >= F.least(F.lit(LEAST_LANGUAGE_SCORE), F.col("score_bound")))
    return unpacked(judged.filter(known), docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts that score below the threshold."""
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), LEAST_QUALITY)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return jaccard_join.one_per_class(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark passage."""
    return template_decontamination.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return sentencepiece_codec.digests(
        sentencepiece_codec.encode_decode(docs, sentencepiece_codec.model_bytes()))


STAGES = [
    ("language_id", known_language),
    ("quality", good_quality),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", encoded),
]

#: SQL can express neither the learned stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
