"""Document quality from a regularised quadratic discriminant over text statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, documents, fold, packed, stage, text_slices, unpacked, with_fields

# Byte classes; UTF-8 bytes above 127 count as lower-case letters.
LOWER, UPPER, DIGIT, SPACE, NEWLINE, COMMON, PIPE, BANG, SYMBOL = range(9)
NAMES = ["log_bytes", "letters", "upper", "digits", "space", "lines", "common_marks", "pipes", "bangs", "symbols",
         "word_mean", "word_sd", "short_words", "marked_words", "capital_words", "distinct_words", "top_word",
         "repeated_lines", "line_words"]
SHRINK_POOLED = 0.2    # weight of the pooled covariance in each class covariance
SHRINK_SPHERE = 0.05   # weight of a sphere of the same trace
TEMPERATURE = 2.0      # divides the log-density difference; statistics are not independent
MIN_CLASS_ROWS = 2     # below this, the class uses the pooled estimate


def _byte_classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.uint8)
    table[128:] = LOWER
    for chars, kind in ((b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
                        (b"0123456789", DIGIT), (b" \t\r", SPACE), (b"\n", NEWLINE), (b".,;:'\"?()-", COMMON),
                        (b"|", PIPE), (b"!", BANG)):
        table[list(chars)] = kind
    return table


BYTE_CLASS = _byte_classes()


def statistics(text: str) -> list[float]:
    """The statistics of a whole text, already transformed: shares by log, lengths by log1p."""
    raw = text.encode("utf-8", "replace")
    n = max(len(raw), 1)
    kinds = np.bincount(BYTE_CLASS[np.frombuffer(raw, np.uint8)], minlength=9) / n
    letters = kinds[LOWER] + kinds[UPPER]
    words = text.split()
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    k = max(len(lines), 1)
    shares = [letters, kinds[UPPER] / max(letters, 1e-9), kinds[DIGIT], kinds[SPACE], kinds[NEWLINE], kinds[COMMON],
              kinds[PIPE], kinds[BANG], kinds[SYMBOL]]
    ends = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,")
    capital = sum(c for w, c in counts.items() if w[0].isupper())
    return [
        float(np.log1p(len(raw))), *(float(np.log(s + 1e-3)) for s in shares),
        float(np.log1p(lengths.mean())), float(np.log1p(lengths.std())), float((lengths <= 3).mean()),
        float(np.log(ends / m + 1e-2)), float(np.log(capital / m + 1e-2)),
        float(np.log(max(len(counts), 1)) / np.log(m + 1.0)), float(np.log(max(counts.values(), default=0) / m + 1e-2)),
        float(np.log((k - len(set(lines))) / k + 1e-2)), float(np.log1p(m / k)),
    ]


def add_statistics(df: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns plus ``stats`` (array of doubles) and ``has_words``."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "__text"):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)),
                 pa.array([statistics(t) for t in texts], pa.list_(pa.float64())),
                 pa.array([bool(t.strip()) for t in texts])],
                names=[*batch.schema.names[:-1], "stats", "has_words"])

    kept = df.select(*keep, F.col(text).alias("__text"))
    return kept.mapInArrow(run, with_fields(kept.schema.fields[:-1], "stats array<double>, has_words boolean"))


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors of the covariances and log determinants, ready for scoring."""

    means: np.ndarray
    inverse_factors: np.ndarray
    log_weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1: logistic of the difference of the Gaussian log densities with priors."""
        logs = []
        for mean, factor, weight in zip(self.means, self.inverse_factors, self.log_weights):
            z = (x - mean) @ factor.T
            logs.append(weight - 0.5 * (z * z).sum(axis=1))
        return 1.0 / (1.0 + np.exp(np.clip((logs[0] - logs[1]) / TEMPERATURE, -60, 60)))


def fit(labelled: DataFrame, stats: str = "stats", label: str = "quality") -> Discriminant | None:
    """Fit from all labelled rows. NULL labels and labels other than 0 and 1 are left out.

    Counts, sums and products are added up by Spark; two fixed-size rows reach the driver. Without rows of
    both classes there is no model, and every score is 0.5.
    """
    d = len(NAMES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, d)
            y = np.array(batch.column(0).to_pylist())
            for c in (0, 1):
                part = x[y == c]
                if len(part):
                    value = np.concatenate([[len(part)], part.sum(0), (part.T @ part).ravel()])
                    sums[c] = sums.get(c, 0) + value
        for c, value in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(value), pa.int32()), pa.array(range(len(value)), pa.int32()), pa.array(value)],
                names=["c", "i", "v"])

    rows = (
        labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("c"), F.col(stats))
        .mapInArrow(moments, "c int, i int, v double").groupBy("c", "i").agg(F.sum("v").alias("v"))
        .orderBy("c", "i").toPandas()
    )
    if rows["c"].nunique() < 2:
        return None
    n, means, scatter = [], [], []
    for c in (0, 1):
        v = rows.loc[rows["c"] == c, "v"].to_numpy()
        n.append(v[0])
        means.append(v[1:1 + d] / v[0])
        scatter.append(v[1 + d:].reshape(d, d) - v[0] * np.outer(means[-1], means[-1]))
    pooled = sum(scatter) / max(sum(n) - 2, 1)
    factors, weights = [], []
    for c in (0, 1):
        own = scatter[c] / (n[c] - 1) if n[c] >= MIN_CLASS_ROWS else pooled
        mixed = (1 - SHRINK_POOLED) * own + SHRINK_POOLED * pooled
        mixed = (1 - SHRINK_SPHERE) * mixed + SHRINK_SPHERE * max(np.trace(mixed) / d, 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        weights.append(np.log(n[c] / sum(n)) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(weights))


def score(df: DataFrame, model: Discriminant | None, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns plus ``score`` from the staged statistics. Texts without words score 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = np.array(batch.column(batch.num_columns - 2).to_pylist(), float).reshape(n, len(NAMES))
            value = model.score(x) if model is not None and n else np.full(n, 0.5)
            value = np.where(np.array(batch.column(batch.num_columns - 1).to_pylist(), bool), value, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 2)), pa.array(value, pa.float64())],
                names=[*batch.schema.names[:-2], "score"])

    kept = df.select(*keep, "stats", "has_words")
    return kept.mapInArrow(run, with_fields(kept.schema.fields[:-2], "score double"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    The text is read once for its statistics, which are staged; labels join those narrow rows. A repeated
    label counts as often as it occurs, and labels without a document count for nothing.
    """
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    stats = stage(add_statistics(docs.withColumn("held_out", held_out), "text", ("doc_id", "held_out")), "quality")
    known = stats.filter(~F.col("held_out")).join(labels.select("doc_id", "quality"), "doc_id")
    scored = score(stats, fit(known), ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``. Statistics are worked out once to learn and once
    to judge, so that texts are not shuffled. ``docs`` may have any columns besides."""
    stats = stage(add_statistics(docs.filter(fold("doc_id", 5) != 0), "text", ("doc_id",)), "quality")
    model = fit(stats.join(labels.select("doc_id", "quality"), "doc_id"))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(NAMES))
            value = model.score(x) if model is not None else np.full(len(texts), 0.5)
            value = np.where([bool(t.strip()) for t in texts], value, 0.0)
            yield batch.filter(pa.array(value >= threshold))

    bounded_batches(docs.sparkSession)
    whole = packed(docs)
    return unpacked(whole.mapInArrow(run, whole.schema), docs.columns)


def op4_quality_qda(spark, sf_dir):
    """Quality score of every document, learned from the labels of the other folds."""
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op4_quality_qda": op4_quality_qda}
