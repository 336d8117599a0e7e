"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, documents, fold, stage, text_slices, with_fields

DIMENSION = 8192   # components of a hypervector: unrelated ones have cosines of about 1 / sqrt(8192) = 0.011
CODES = 64         # letter symbols: 0 separates words, others by letter
NGRAM = 3
SEED = 20240229
DEVIATIONS = 3     # standard deviations that a text may lie below what is expected of its n-grams
DENSE = 0.015      # share of a slice's texts that hold an n-gram, from which on it is bundled for all of them
BOUND_AT_ONCE = 256  # bound vectors held at a time
PROTOTYPE_ROWS = "lang string, gram int, n long"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_code(point: int) -> int:
    """Symbol of a code point: 0 for no letter, one each for a-z, a hash of the lower-case letter otherwise."""
    low = chr(point).lower()[:1]
    if not low.isalpha():
        return 0
    if low in LETTERS:
        return 1 + LETTERS.index(low)
    return 27 + (ord(low) * 2654435761 >> 7) % (CODES - 27)


class Encoder:
    """Turns texts into counts of letter n-grams, and n-grams into bound hypervectors."""

    def __init__(self) -> None:
        self.codes = np.full(0x110000, 255, np.uint8)
        rng = np.random.default_rng(SEED)
        self.letters = rng.choice(np.array([-1, 1], np.int8), (CODES, DIMENSION))
        self.older, self.oldest = np.roll(self.letters, 1, 1), np.roll(self.letters, 2, 1)

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the whole text, as numbers, and their counts. Runs of non-letters count once."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        code = self.codes[points]
        if (code == 255).any():
            for p in np.unique(points[code == 255]).tolist():
                self.codes[p] = letter_code(p)
            code = self.codes[points]
        code = np.concatenate([np.zeros(1, np.uint8), code, np.zeros(1, np.uint8)])
        code = code[np.concatenate([[True], (code[1:] | code[:-1]) != 0])].astype(np.int32)
        if len(code) < NGRAM:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        number = (code[:-2] * CODES + code[1:-1]) * CODES + code[2:]
        if len(number) > 20_000:
            counts = np.bincount(number, minlength=CODES ** NGRAM)
            found = np.flatnonzero(counts)
            return found, counts[found]
        return np.unique(number, return_counts=True)

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """Vector of each n-gram: the older a letter, the further it is rotated, then multiplied."""
        pairs = grams // CODES
        return (self.oldest[pairs // CODES] * self.older[pairs % CODES] * self.letters[grams % CODES]).astype(np.float32)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the bound n-gram vectors, each as often as the n-gram occurs."""
        total = np.zeros(DIMENSION, np.float32)
        for at in range(0, len(grams), BOUND_AT_ONCE):
            total += counts[at:at + BOUND_AT_ONCE].astype(np.float32) @ self.bound(grams[at:at + BOUND_AT_ONCE])
        return total

    def bundles(self, profiles: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One bundle per text; n-grams that many of the texts hold are bound once for all of them."""
        total = np.zeros((len(profiles), DIMENSION), np.float32)
        if not profiles:
            return total
        held = np.bincount(np.concatenate([g for g, _ in profiles]).astype(np.int64), minlength=CODES ** NGRAM)
        common = held > max(1, DENSE * len(profiles))
        place = np.cumsum(common) - 1
        shared = np.flatnonzero(common)
        dense = np.zeros((len(profiles), len(shared)), np.float32)
        for i, (grams, counts) in enumerate(profiles):
            often = common[grams]
            dense[i, place[grams[often]]] = counts[often]
            total[i] = self.bundle(grams[~often], counts[~often])
        for at in range(0, len(shared), BOUND_AT_ONCE):
            total += dense[:, at:at + BOUND_AT_ONCE] @ self.bound(shared[at:at + BOUND_AT_ONCE])
        return total


class Prototypes(dict):
    """Unit prototype of each language. ``spread`` has, per language, the mean and the standard deviation of the
    cosine that a single n-gram drawn from it has with the exact profile."""

    def __init__(self) -> None:
        super().__init__()
        self.spread: dict[str, tuple[float, float]] = {}


_ENCODER: list[Encoder] = []


def encoder() -> Encoder:
    """One encoder per Python worker."""
    if not _ENCODER:
        _ENCODER.append(Encoder())
    return _ENCODER[0]


def _count_profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch, texts in text_slices(batches):
        enc = encoder()
        for lang, text in zip(batch.column(1).to_pylist(), texts):
            if lang not in totals:
                totals[lang] = np.zeros(CODES ** NGRAM, np.int64)
            grams, counts = enc.grams(text)
            totals[lang][grams] += counts
    for lang, counts in totals.items():
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(counts[found])],
            names=["lang", "gram", "n"])


def _bundle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's part of each language's bundle, from its rows of n-gram counts."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, grams = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
        counts = batch.column(2).to_numpy().astype(np.float64)
        for lang in set(langs):
            mine = np.flatnonzero(langs == lang)
            total = totals.setdefault(lang, np.zeros(DIMENSION))
            for at in range(0, len(mine), BOUND_AT_ONCE):
                some = mine[at:at + BOUND_AT_ONCE]
                total += counts[some] @ encoder().bound(grams[some])
    for lang, total in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total], pa.list_(pa.float64()))], names=["lang", "bundle"])


def train(df: DataFrame, lang: str = "lang", text: str = "text") -> Prototypes:
    """Unit prototype of each language, from all rows with a language.

    Tasks count n-grams per language, Spark adds the counts up, and tasks bundle what they hold of them; sums of whole
    numbers are exact, so the order of tasks does not matter. The driver gets one hypervector and three sums per language,
    which every task needs to predict. Empty input gives no prototypes.
    """
    bounded_batches(df.sparkSession)
    counts = stage(
        df.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .mapInArrow(_count_profiles, PROTOTYPE_ROWS)
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "n-grams")
    n = F.col("n").cast("double")
    sums = {r.lang: r for r in counts.groupBy("lang").agg(
        F.sum(n).alias("s1"), F.sum(n * n).alias("s2"), F.sum(n * n * n).alias("s3")).collect()}
    parts = counts.select("lang", "gram", "n").mapInArrow(_bundle_counts, "lang string, bundle array<double>")
    bundles: dict[str, np.ndarray] = {}
    for r in parts.select("lang", F.posexplode("bundle").alias("at", "x")).groupBy("lang", "at").agg(
            F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v")).select(
            "lang", F.transform("v", lambda e: e["x"]).alias("v")).collect():
        bundles[r.lang] = np.array(r.v)
    prototypes = Prototypes()
    for name in sorted(bundles):
        total, s = bundles[name], sums[name]
        prototypes[name] = (total / max(float(np.linalg.norm(total)), 1e-12)).astype(np.float32)
        mean = math.sqrt(s.s2) / s.s1
        prototypes.spread[name] = mean, math.sqrt(max(s.s3 / s.s1 ** 3 / mean ** 2 - mean ** 2, 0.0))
    return prototypes


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text",
            keep: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine with the best prototype, 0 to 1) and ``score_bound`` to the ``keep`` columns,
    and to the text itself, named ``text``, if ``keep_text`` is set.

    ``score_bound`` is what nearly every text with the same number of n-grams, drawn from any of the languages,
    reaches: ``DEVIATIONS`` standard deviations below the expected cosine, those of the draw and of the
    hypervectors together. It is 0 or less where a text is too short to tell, and without ``Prototypes.spread``.

    A text that is NULL or has no letter gets ``und`` and 0, as does any text if nothing was learned. Equal
    cosines go to the language first in order. Whole texts are read, whatever their length.
    """
    bounded_batches(df.sparkSession)
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float32).reshape(len(names), DIMENSION)
    spread = getattr(prototypes, "spread", {})
    means = np.array([spread.get(n, (0.0, 0.0))[0] for n in names])
    allowed = DEVIATIONS * np.sqrt(np.array([spread.get(n, (0.0, 0.0))[1] for n in names]) ** 2 + 1 / DIMENSION)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch, texts in text_slices(batches, "__text"):
            profiles = [enc.grams(t) for t in texts]
            langs, scores, bounds = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            told = [i for i, (grams, _) in enumerate(profiles) if len(grams) and names]
            vectors = enc.bundles([profiles[i] for i in told])
            for i, vector in zip(told, vectors):
                counts = profiles[i][1].astype(np.float64)
                cosines = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-12)
                best = int(cosines.argmax())
                langs[i] = names[best]
                scores[i] = float(min(max(cosines[best], 0.0), 1.0))
                bounds[i] = float((means * (counts.sum() / np.linalg.norm(counts)) - allowed).min())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *batch.columns[-1:] * keep_text, pa.array(langs), pa.array(scores), pa.array(bounds)],
                names=[*batch.schema.names[:-1], *["text"] * keep_text, "lang_pred", "score", "score_bound"])

    kept = df.select(*keep, F.col(text).alias("__text"))
    return kept.mapInArrow(run, with_fields(
        kept.schema.fields[:-1], "text string, " * keep_text + "lang_pred string, score double, score_bound double"))


def op5_language_id(spark, sf_dir):
    """Language of every document; learned from the documents of the other folds."""
    docs = documents(spark, sf_dir)
    held_out = fold("doc_id", 4) == 2
    prototypes = train(docs.filter(~held_out))
    return predict(docs.withColumn("held_out", held_out), prototypes, keep=("doc_id", "held_out")).select(
        "doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op5_language_id": op5_language_id}
