"""Exact centroid clustering of integer vectors, with distances worked out per distinct subvector."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stage

DIMENSION = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
CHUNK = 2048             # vectors that share dictionaries: a row of the encoded table, about 0.4 MB
BATCH_BYTES = "32m"
WIDTHS = (16, 8, 4, 2, 1)  # components per block, tried from the widest
LEAST_REPEATS = 4        # vectors per distinct subvector that make a block worth its width
LARGEST = 1 << 27        # components beyond this could overflow a distance


def whole_numbers(column: str, dimension: int = DIMENSION, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; NULL for vectors of another length or with NULL or non-finite components."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.forall(column, lambda x: F.abs(x.cast("double")) * scale < LARGEST)
    numbers = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when((F.size(column) == dimension) & finite, F.when(small, numbers).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<bigint>")))


class Chunk:
    """Vectors as codes into one dictionary of distinct subvectors per block; nothing is lost."""

    def __init__(self, width: int, starts: np.ndarray, entries: np.ndarray, codes: np.ndarray) -> None:
        self.width, self.starts, self.entries, self.codes = width, starts, entries, codes

    @staticmethod
    def encode(vectors: np.ndarray) -> "Chunk":
        """The widest blocks whose subvectors repeat often enough, or else single components."""
        n, dimension = vectors.shape
        for width in WIDTHS:
            if dimension % width:
                continue
            found = [np.unique(vectors[:, b:b + width], axis=0, return_inverse=True) for b in range(0, dimension, width)]
            if width == 1 or sum(len(e) for e, _ in found) * LEAST_REPEATS <= n * len(found):
                break
        sizes = [len(e) for e, _ in found]
        return Chunk(width, np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([e for e, _ in found]),
                     np.stack([c.reshape(-1) for _, c in found], axis=1).astype(np.uint16))

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances (vector, centroid): partial ones per distinct subvector, summed by code."""
        total = np.zeros((len(self.codes), len(centroids)), np.int64)
        for b, (low, high) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            entries = self.entries[low:high]
            part = centroids[:, b * self.width:(b + 1) * self.width]
            table = ((entries[:, None, :] - part[None]) ** 2).sum(axis=2)
            total += table[self.codes[:, b]]
        return total

    def sums(self, labels: np.ndarray, clusters: int) -> np.ndarray:
        """Componentwise sums per cluster, from the number of times that each cluster holds each subvector."""
        parts = []
        for b, (low, high) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            size = high - low
            held = np.bincount(labels * size + self.codes[:, b], minlength=clusters * size).reshape(clusters, size)
            parts.append(held @ self.entries[low:high])
        return np.concatenate(parts, axis=1)


ENCODED = "ids array<long>, width int, starts array<int>, entries binary, codes binary"


def encode(vectors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per ``chunk`` vectors of a task: their ids (vec_id) and codes, and the dictionaries, as bytes."""

    def row(ids: list, held: list) -> pa.RecordBatch:
        c = Chunk.encode(np.array(held, np.int64))
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), pa.array([c.width], pa.int32()),
            pa.array([c.starts.tolist()], pa.list_(pa.int32())), pa.array([c.entries.astype("<i4").tobytes()], pa.binary()),
            pa.array([c.codes.astype("<u2").tobytes()], pa.binary())], names=["ids", "width", "starts", "entries", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            held += batch.column(1).to_pylist()
            while len(ids) >= chunk:
                yield row(ids[:chunk], held[:chunk])
                ids, held = ids[chunk:], held[chunk:]
        if ids:
            yield row(ids, held)

    return vectors.select(F.col("vec_id").cast("long"), "numbers").mapInArrow(run, ENCODED)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, Chunk]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, width, starts, entries, codes = (batch.column(k)[i].as_py() for k in range(5))
            yield ids, Chunk(width, np.array(starts), np.frombuffer(entries, "<i4").astype(np.int64).reshape(-1, width),
                             np.frombuffer(codes, "<u2").astype(np.int64).reshape(len(ids), -1))


def nearest(chunk: Chunk, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid; of equally near ones the first."""
    distances = chunk.distances(centroids)
    labels = distances.argmin(axis=1)
    return labels, distances[np.arange(len(labels)), labels]


def cluster_sums(encoded: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Per cluster: vectors, summed distance, componentwise sums. Only clusters times components reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in chunks(batches):
            labels, distances = nearest(chunk, centroids)
            sums = chunk.sums(labels, len(centroids))
            for k in np.unique(labels):
                inside = labels == k
                values = [int(inside.sum()), int(distances[inside].sum()), *sums[k].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k)], pa.int32()), pa.array([values], pa.list_(pa.int64()))], names=["cluster", "numbers"])

    parts = encoded.mapInArrow(run, "cluster int, numbers array<long>")
    rows = parts.select("cluster", F.posexplode("numbers").alias("at", "number")).groupBy("cluster", "at").agg(
        F.sum(F.col("number").cast("decimal(19,0)")).alias("total")).collect()
    found: dict[int, dict[int, int]] = {}
    for r in rows:
        found.setdefault(r.cluster, {})[r["at"]] = int(r.total)
    return {k: (v[0], v[1], [v[i] for i in range(2, len(v))]) for k, v in found.items()}


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in order; equal ids come in order of their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(name, "numbers").limit(clusters).select("numbers").collect()
    return np.array([r.numbers for r in rows], np.int64)


def cluster(df: DataFrame, vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
            dimension: int = DIMENSION, scale: int = SCALE, chunk: int = CHUNK) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (array) per vector.

    Vectors become whole numbers and are encoded once, ``chunk`` at a time, with a dictionary of distinct subvectors per
    block of components; the encoded table is staged. A round works out the distances of a chunk's dictionary to
    the centroids, sums them by code, and adds up each cluster; clusters times components numbers come to the driver. The
    last pass assigns once more. All of it is in whole numbers, so results do not depend on chunks or tasks.

    Vectors that are NULL, of another length, or hold NULL or non-finite components are left out. Repeated rows and
    equal ids are vectors like others; a NULL id hashes as an empty one. With fewer vectors than clusters each starts a
    cluster; equal centroids leave all but the first empty. An empty table gives no rows. Components of 2**27 or more
    after scaling end the job with an error, since distances would not fit a long.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)  # a row of the encoded table is large
    vectors = df.select("vec_id", whole_numbers(vector, dimension, scale).alias("numbers")).filter("numbers IS NOT NULL")
    encoded = stage(encode(vectors, chunk), "encoded-vectors")
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        for k, (count, _, sums) in cluster_sums(encoded, centroids).items():
            centroids[k] = [total // count for total in sums]
    inertias = {k: v[1] for k, v in cluster_sums(encoded, centroids).items()} if len(centroids) else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in chunks(batches):
            labels, distances = nearest(held, centroids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(distances, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    def per_cluster(values: dict[int, object], kind: str) -> Column:
        chosen = F.lit(None).cast(kind)
        for k, value in values.items():
            given = F.array(*[F.lit(v).cast("long") for v in value]) if kind == "array<bigint>" else F.lit(value).cast(kind)
            chosen = F.when(F.col("cluster") == k, given).otherwise(chosen)
        return chosen

    return encoded.mapInArrow(run, "vec_id long, cluster int, distance long").select(
        "vec_id", "cluster", "distance", per_cluster(inertias, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertias.values())).cast("long").alias("inertia"),
        per_cluster({k: centroids[k].tolist() for k in inertias}, "array<bigint>").alias("centroid"))


def op13_centroid_clusters(spark, sf_dir):
    """Every usable vector with its cluster, after ten rounds."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256).alias("centroid_sha256"))


QUERIES = {"op13_centroid_clusters": op13_centroid_clusters}


def _sql() -> str:
    """The rounds one after another; sums stay exact in wide whole numbers."""

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, q, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT r, vec_id, v.q, k, list_sum(list_transform(range(1, {DIMENSION + 1}), lambda j: (v.q[j] - c.q[j]) * (v.q[j] - c.q[j])))::BIGINT AS d
    FROM v, c{i} c) GROUP BY r, vec_id, q)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS q FROM (
      SELECT k, j, sum(q[j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i}, range(1, {DIMENSION + 1}) t(j) GROUP BY k, j) GROUP BY k) m USING (k))"""

    rounds = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(ROUNDS))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSION}),
c0 AS MATERIALIZED (
  SELECT k - 1 AS k, q FROM (SELECT q, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), q) AS k FROM v)
  WHERE k <= {CLUSTERS}),
{rounds},
{assigned(ROUNDS)}
SELECT vec_id, k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c USING (k)
"""


ORACLE = {"op13_centroid_clusters": _sql()}
