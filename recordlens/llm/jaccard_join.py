"""Similarity join of texts on word shingles by chosen paths."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bounded_batches, bounded_broadcast, documents, local_forest, packed, sorted_by, stage, text_slices, unpacked)
from .components import connected_components

WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.999
SMALL = 2000             # sets per bucket that are compared pair by pair
BLOCK = 500              # sets per block, where blocks are compared with each other
DENSE = 0.6              # mean share of equal minima from which a bucket is not split further
DEEPER = 3.0             # tokens chosen per set below the first level, times 1 / similarity
MOST_LEVELS = 5          # buckets that are still large go to block-by-block comparison
SKETCH = 64              # one-byte minima in a sketch
SKETCH_LEAST = 40        # equal minima that make a candidate: 3.5 deviations below what the similarity gives
AUDITED = 256            # texts whose partners are found by brute force, to measure the recall
AUDIT_CHARS = 20_000     # length of an audited text: bounds what is sent to every task
MOST_ROUNDS = 8          # rounds of runs before the join gives up on the target
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        inverse = U(pow(int(BASE), -1, 1 << 64))
        for i, factor in enumerate((BASE, inverse)):
            steps = np.full(size, factor, U)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[list(b"abcdefghijklmnopqrstuvwxyz0123456789_")] = True
WORD_BYTE[128:] = True


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``words`` words of the lower-case text.

    Words are runs of letters, digits, underscores and non-ASCII characters. A text with fewer words has
    one shingle of all of them; without words it has none.
    """
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    inside = np.concatenate([[False], WORD_BYTE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, U)
    up, down = _powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, U), np.cumsum((raw.astype(U) + U(1)) * up[:len(raw)])])
    word = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))
    k = min(words, len(word))
    out = np.zeros(len(word) - k + 1, U)
    for i in range(k):
        out = mix(out + word[i:len(word) - k + 1 + i])
    return np.unique(out)


def sketch_factors(number: int) -> np.ndarray:
    """Hash functions of a round's sketches."""
    return mix(np.arange(number * SKETCH + 1, (number + 1) * SKETCH + 1, dtype=U)) | U(1)


def sketch(tokens: np.ndarray, factors: np.ndarray) -> bytes:
    """Last byte of the smallest value under each of the sketch's hash functions."""
    least = np.full(SKETCH, ~U(0))
    for at in range(0, len(tokens), 4096):
        values = tokens[None, at:at + 4096] * factors[:, None]
        values ^= values >> U(29)
        least = np.minimum(least, (values * U(0xBF58476D1CE4E5B9)).min(axis=1))
    return (mix(least) & U(255)).astype(np.uint8).tobytes()


def chosen(tokens: np.ndarray, node: int, factor: float, similarity: float) -> np.ndarray:
    """Children of a node for a set: each token is chosen with chance factor / (similarity * size)."""
    share = factor / (similarity * len(tokens))
    drawn = mix(tokens ^ mix(np.array([node], np.int64).view(U)))
    picked = drawn if share >= 1 else drawn[drawn < U(int(share * 2.0 ** 64))]
    return mix(picked + U(1)).view(np.int64)


def digest(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


class Audit:
    """Shingle sets of a few texts, and which of them a set is similar to, by counting common shingles."""

    def __init__(self, texts: list[str], words: int, similarity: float) -> None:
        by_node = {digest(s): s for s in (shingles(t, words) for t in texts) if len(s)}
        sets = list(by_node.values())
        self.similarity, self.nodes = similarity, np.array(list(by_node), np.int64)
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        tokens = np.concatenate([np.empty(0, U), *sets])
        order = np.argsort(tokens, kind="stable")
        self.holders = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.tokens, first = np.unique(tokens[order], return_index=True)
        self.bounds = np.append(first, len(tokens))

    def partners(self, tokens: np.ndarray, node: int) -> list[int]:
        """Audited nodes other than ``node`` with the similarity or more."""
        if not len(self.tokens):
            return []
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        at = at[self.tokens[at] == tokens]
        if not len(at):
            return []
        size = self.bounds[at + 1] - self.bounds[at]
        places = np.arange(int(size.sum())) + np.repeat(self.bounds[at] - np.cumsum(size) + size, size)
        common = np.bincount(self.holders[places], minlength=len(self.nodes))
        like = common >= self.similarity * (self.sizes + len(tokens) - common) - 1e-9
        return self.nodes[like & (self.nodes != node)].tolist()


def audit_texts(keyed: DataFrame, audited: int) -> list[str]:
    """The texts to audit: those with the smallest hashes of their rows, at most ``audited`` of at most AUDIT_CHARS each."""
    some = keyed.filter(F.length("text").between(1, AUDIT_CHARS)).orderBy(F.xxhash64("row"), "row").limit(audited)
    return [r.text for r in some.select("text").collect()]


def profile(df: DataFrame, runs: range, number: int, words: int, similarity: float, audit: Audit | None = None) -> DataFrame:
    """doc_id, row, node (a digest of the shingles; NULL without words), n, sketch (that of round ``number``), keys
    (first-level choices of the runs), audited (audited nodes that are similar).
    """
    factors = sketch_factors(number)
    shared = df.sparkSession.sparkContext.broadcast(audit)  # at most AUDITED texts of AUDIT_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit = shared.value
        for batch, texts in text_slices(batches):
            nodes, sizes, sketches, keys, audited = [], [], [], [], []
            for t in texts:
                tokens = shingles(t, words)
                some = len(tokens) > 0
                nodes.append(digest(tokens) if some else None)
                sizes.append(len(tokens))
                sketches.append(sketch(tokens, factors) if some else b"")
                keys.append(np.concatenate([chosen(tokens, r, 1.0, similarity) for r in runs]) if some else [])
                audited.append(audit.partners(tokens, nodes[-1]) if some and audit else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(sketches, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(audited, pa.list_(pa.int64()))],
                names=["doc_id", "row", "node", "n", "sketch", "keys", "audited"])

    return df.select("doc_id", "row", "text").mapInArrow(
        run, "doc_id long, row long, node long, n int, sketch binary, keys array<long>, audited array<long>")


def candidates(keyed: DataFrame, nodes: DataFrame, pairs: DataFrame, runs: int, words: int, similarity: float,
               target_recall: float, small: int, block: int, report: list | None) -> DataFrame:
    """node, component of the candidate edges: rounds of runs, until the audited texts meet their partners.

    The recall is the share of its partners that lie in an audited text's component, averaged over the audited texts that
    have any, so that those of large groups count like others. Each round doubles the runs and has a sketch of its own.
    The audited pairs are edges as well.
    """
    edges, done, number = None, 0, 0
    while True:
        if number:
            texts = keyed.join(bounded_broadcast(nodes.select("row")), "row", "left_semi").dropDuplicates(["row"])
            nodes = stage(profile(texts, range(done, done + runs), number, words, similarity), "nodes-again")
        found = candidate_edges(keyed, nodes, words, similarity, small, block)
        edges = found if edges is None else edges.unionByName(found)
        near = connected_components(edges)
        recall = audited_recall(near, pairs)
        done, number = done + runs, number + 1
        if report is not None:
            report.append((done, recall))
        if recall >= target_recall:
            return near if recall == 1 else connected_components(stars(near).unionByName(pairs))
        if number == MOST_ROUNDS:
            raise RuntimeError(f"recall {recall:.4f} of the audited texts after {done} runs, wanted {target_recall}")
        edges, runs = stars(near), done


def stars(near: DataFrame) -> DataFrame:
    """Edges of the components."""
    return near.select(F.col("node").alias("a"), F.col("component").alias("b"))


def audited_recall(near: DataFrame, pairs: DataFrame) -> float:
    """Mean share of the partners (b) of an audited node (a) that are in its component; 1 without any pair."""
    left = near.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = near.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    met = pairs.join(left, "a", "left").join(right, "b", "left").groupBy("a").agg(
        F.avg(F.coalesce(F.col("ca") == F.col("cb"), F.lit(False)).cast("int")).alias("met"))
    share = met.agg(F.avg("met")).first()[0]
    return 1.0 if share is None else share


def grouped(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Tables of whole groups of equal keys, from batches that are sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = batch.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last == 0 and len(held) > 1 and held[-2].column(key)[-1].as_py() == keys[0]:
            continue
        if last == 0 and len(held) == 1:
            continue
        held[-1] = batch.slice(0, last)
        yield pa.Table.from_batches([h for h in held if h.num_rows])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def pair_chunks(starts: np.ndarray, size: int, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs in groups of one size that begin at ``starts``, some at a time."""
    if size * (size - 1) // 2 <= most:
        left, right = np.triu_indices(size, 1)
        step = max(1, most // len(left))
        for at in range(0, len(starts), step):
            yield (starts[at:at + step, None] + left).ravel(), (starts[at:at + step, None] + right).ravel()
        return
    rows = max(1, most // size)
    for start in starts.tolist():
        for at in range(0, size, rows):
            left, right = np.nonzero(np.arange(at, min(at + rows, size))[:, None] < np.arange(size)[None])
            yield start + at + left, start + right


def compare_buckets(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Candidate edges of each bucket, as stars: sizes near enough and sketches alike enough."""
    for table in grouped(batches):
        keys, nodes = table.column(0).to_numpy(), table.column(1).to_numpy()
        sizes = table.column(2).to_numpy().astype(float)
        marks = np.frombuffer(b"".join(table.column(3).to_pylist()), np.uint8).reshape(-1, SKETCH).view(U)
        edges: list[tuple[int, int]] = []
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(starts, len(keys)))
        for size in np.unique(counts[counts > 1]).tolist():
            of = starts[counts == size]
            for a, b in pair_chunks(of, size):
                near = np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b])
                near &= nodes[a] != nodes[b]
                a, b = a[near], b[near]
                same = np.zeros(len(a), np.int32)
                for word in range(SKETCH // 8):
                    same += (((marks[a, word] ^ marks[b, word])[:, None].view(np.uint8)) == 0).sum(axis=1, dtype=np.int32)
                hit = same >= SKETCH_LEAST
                edges += zip(nodes[a[hit]].tolist(), nodes[b[hit]].tolist())
            edges = local_forest(edges)
        if edges:
            yield edge_batch(edges)


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])


def verify_cells(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Exact links in each cell: per node how many copies it is linked with, and the links as stars.

    A cell holds one block (all pairs) or two different ones (pairs across).
    """
    for table in grouped(batches):
        for cell in table.group_by("cell", use_threads=False).aggregate([("cell", "count")]).column(0).to_pylist():
            part = table.filter(pa.compute.equal(table.column("cell"), cell))
            nodes, copies = part.column("node").to_numpy(), part.column("copies").to_numpy()
            sides = part.column("side").to_numpy()
            sets = [np.frombuffer(s, U) for s in part.column("tokens").to_pylist()]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            _, code = np.unique(np.concatenate(sets), return_inverse=True)
            offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mark, links, edges = np.zeros(int(code.max()) + 1, bool), np.zeros(len(sets), np.int64), []
            across = bool(sides[0])
            for i in range(len(sets)):
                if sides[i] == 2:
                    continue
                own = code[offsets[i]:offsets[i] + sizes[i]]
                others = np.flatnonzero(
                    (sides == 2 if across else np.arange(len(sets)) > i)
                    & (np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i])))
                if not len(others):
                    continue
                mark[own] = True
                if len(others) * 2 > len(sets):
                    common = np.add.reduceat(mark[code], offsets, dtype=np.int64)[others]
                else:
                    common = np.array([np.count_nonzero(mark[code[offsets[j]:offsets[j] + sizes[j]]]) for j in others])
                mark[own] = False
                hit = others[common >= similarity * (sizes[i] + sizes[others] - common) - 1e-9]
                links[i] += copies[hit].sum()
                links[hit] += copies[i]
                edges += [(int(nodes[i]), int(x)) for x in nodes[hit]]
            counted = np.flatnonzero(links)
            forest = local_forest(edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*nodes[counted].tolist(), *(e[0] for e in forest)], pa.int64()),
                 pa.array([*[None] * len(counted), *(e[1] for e in forest)], pa.int64()),
                 pa.array([*links[counted].tolist(), *[None] * len(forest)], pa.int64())], names=["a", "b", "links"])


def token_sets(keyed: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, tokens (their hashes as bytes) of the wanted (row, node), from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sets = [shingles(t, words) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "tokens"])

    rows = bounded_broadcast(wanted.select("row").distinct())
    found = keyed.join(rows, "row", "left_semi").select("row", "text").dropDuplicates(["row"])
    return found.select("text").mapInArrow(run, "node long, tokens binary")


def candidate_edges(keyed: DataFrame, nodes: DataFrame, words: int, similarity: float, small: int, block: int) -> DataFrame:
    """Edges between sets that look alike, from buckets of chosen paths that are split until they are small."""
    entries = nodes.select("node", "row", "n", "sketch", F.explode("keys").alias("key"))
    edges = None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return compare_buckets(batches, similarity)

    def take(rows: DataFrame) -> None:
        nonlocal edges
        part = sorted_by(rows.select("key", "node", "n", "sketch"), "key").mapInArrow(compare, "a long, b long")
        edges = part if edges is None else edges.unionByName(part)

    for level in range(1, MOST_LEVELS + 1):
        large = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(
            F.col("size") > small).select("key"), "large-buckets")
        if large.isEmpty():
            take(entries)
            return edges
        large = bounded_broadcast(large)
        take(entries.join(large, "key", "left_anti"))
        rest = stage(entries.join(large, "key", "left_semi").select("key", "node", "row", "n", "sketch"), "large-rows")
        # Sets that are much like the others of their bucket would never part: they are compared in blocks.
        dense = dense_buckets(rest)
        if level == MOST_LEVELS:
            dense = rest.select("key").distinct()
        dense = stage(dense, "dense-buckets")
        edges = edges.unionByName(block_edges(rest.join(bounded_broadcast(dense), "key", "left_semi"), similarity, block))
        rest = rest.join(bounded_broadcast(dense), "key", "left_anti")
        if level == MOST_LEVELS or rest.isEmpty():
            return edges
        sets = token_sets(keyed, rest, words)
        entries = stage(split(rest.join(sets, "node"), similarity), "split-buckets")
    return edges


def dense_buckets(rest: DataFrame) -> DataFrame:
    """Keys of buckets in which two sets have, on average, nearly the wanted share of equal minima.

    The mean is taken over neighbours in the order of the digests, which is a random one: as many pairs as
    the bucket has sets. A bucket's rows are split over tasks, and only sums leave them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, SKETCH)
            same = (marks[1:] == marks[:-1]).sum(axis=1)
            within = keys[1:] == keys[:-1]
            found, at = np.unique(keys[1:][within], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.bincount(at, same[within], len(found))),
                 pa.array(np.bincount(at, minlength=len(found)).astype(float))], names=["key", "same", "pairs"])

    parts = rest.select("key", "sketch", "node", F.pmod("node", F.lit(16)).alias("part")).repartition("key", "part")
    sums = parts.sortWithinPartitions("key", "part", "node").select("key", "sketch").mapInArrow(
        run, "key long, same double, pairs double")
    return sums.groupBy("key").agg((F.sum("same") / F.sum("pairs") / SKETCH).alias("alike")).filter(
        F.col("alike") >= DENSE).select("key")


def split(rows: DataFrame, similarity: float) -> DataFrame:
    """Children of each (key, set): the next level of the paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kids = [chosen(np.frombuffer(t, U), k, DEEPER, similarity) for k, t in zip(
                batch.column(0).to_pylist(), batch.column(5).to_pylist())]
            at = np.repeat(np.arange(len(kids)), [len(k) for k in kids])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(at)) for i in (1, 2, 3, 4)),
                 pa.array(np.concatenate(kids) if kids else [], pa.int64())], names=["node", "row", "n", "sketch", "key"])

    return rows.select("key", "node", "row", "n", "sketch", "tokens").mapInArrow(
        run, "node long, row long, n int, sketch binary, key long")


def block_cells(df: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Cells of at most about 2 * ``block`` rows in which every two rows of a group meet exactly once.

    A group is cut into blocks; a cell is a block with itself or with another. Adds ``cell`` and ``side``:
    0 in a cell of one block, else 1 and 2 for the lower and the higher block.
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    placed = df.withColumn("_n", blocks).withColumn("_own", own)
    spread = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return spread.withColumn("cell", F.xxhash64(F.col(group), low, high)).withColumn(
        "side", F.when(F.col("_own") == F.col("_other"), 0).otherwise(
            F.when(F.col("_own") < F.col("_other"), 1).otherwise(2))).drop("_n", "_own", "_other")


def block_edges(rows: DataFrame, similarity: float, block: int) -> DataFrame:
    """Candidate edges of large buckets, block by block."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return compare_buckets(batches, similarity)

    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    cells = block_cells(rows.join(bounded_broadcast(sizes), "key"), "key", "size", block)
    return sorted_by(cells.select("cell", "node", "n", "sketch"), "cell").mapInArrow(compare, "a long, b long")


def similar_texts(docs: DataFrame, text: str = "text", words: int = WORDS, similarity: float = SIMILARITY,
                  target_recall: float = TARGET_RECALL, small: int = SMALL, block: int = BLOCK, first_runs: int | None = None,
                  audited: int = AUDITED, report: list | None = None) -> DataFrame:
    """doc_id, class_id, n_links, row, group per row: links are other rows with a Jaccard similarity of
    ``similarity`` or more. ``row`` is a hash of doc_id and text, ``group`` is the same for all rows of a class.

    1. Texts with equal shingle sets become one node with a number of copies.
    2. Each node chooses shingles in several runs; nodes that chose the same one meet in a bucket. A large bucket
       is split by choosing again below it, and one whose sets are all alike is compared block by block.
       The first round has ``first_runs``, by default from the target recall as if a run missed a pair with chance 1/e.
       ``audited`` texts (bounded in length too) are compared with all others by brute force, in the pass that reads the
       texts; while their recall is below the target, rounds with as many runs again and a new sketch follow. After
       MOST_ROUNDS the join raises an error. ``report`` receives (runs so far, audited recall) per round.
    3. Sizes and sketches turn buckets into candidate edges; their components are compared exactly, every
       pair of a component in one cell. Links are counted there and kept as stars.

    class_id is the smallest doc_id among the rows that links connect (NULL ids count last). Texts without
    words (also NULL) are linked with nothing and are their own class. Rows that repeat a doc_id are rows like
    others. Nodes are 64-bit digests of the sets.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    runs = first_runs or math.ceil(math.log(1 / (1 - target_recall)))
    keyed = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "row", F.xxhash64("doc_id", "text"))
    audit = Audit(audit_texts(keyed, audited), words, similarity)
    rows = stage(profile(keyed, range(runs), 0, words, similarity, audit), "profiles")
    nodes = stage(rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"), F.min("row").alias("row"),
        F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value("keys").alias("keys")), "nodes")
    pairs = stage(rows.select(F.explode("audited").alias("a"), F.col("node").alias("b")).distinct(), "audited-pairs")
    near = candidates(keyed, nodes, pairs, runs, words, similarity, target_recall, small, block, report)
    members = stage(near.join(nodes.select("node", "row", "copies"), "node"), "candidates")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sets = token_sets(keyed, members, words)
    cells = block_cells(members.join(bounded_broadcast(sizes), "component"), "component", "size", block).join(sets, "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        return verify_cells(batches, similarity)

    found = stage(sorted_by(cells.select("cell", "side", "node", "copies", "tokens"), "cell").mapInArrow(
        verify, "a long, b long, links long"), "links")
    links = found.filter("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    linked = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    named = linked.join(nodes.select("node", "doc_id"), "node")
    classes = named.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    by_node = linked.join(classes, "component").select("node", "class_id", "component")
    salts = 16
    info = nodes.select("node", "doc_id", "copies").join(links, "node", "left").join(by_node, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("class_id", "doc_id").alias("class_id"), "component").filter(
        F.col("n_links") > 0).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Copies of one text may be many: their rows are salted.
    return rows.select("doc_id", "row", "node", F.pmod("row", F.lit(salts)).cast("int").alias("salt")).join(
        info, ["node", "salt"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "row", F.coalesce("component", "node", "row").alias("group"))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, one of each class: that with the smallest doc_id (NULL last).

    Only the rows that go are joined back to the texts. ``docs`` may have any columns besides.
    """
    classes = stage(similar_texts(docs, **options), "classes")
    first = classes.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("m"))
    gone = classes.select("row").distinct().join(first.select("m.row"), "row", "left_anti")
    repeated = classes.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("row")
    keyed = packed(docs, row=F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    left = keyed.join(bounded_broadcast(stage(gone, "gone")), "row", "left_anti")
    repeated = bounded_broadcast(stage(repeated, "repeated"))
    once = left.join(repeated, "row", "left_anti")
    if not repeated.isEmpty():
        once = once.unionByName(left.join(repeated, "row", "left_semi").dropDuplicates(["row"]))
    return unpacked(once, docs.columns)


def op8_jaccard_join(spark, sf_dir):
    """Every document with its class and its number of links."""
    return similar_texts(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


QUERIES = {"op8_jaccard_join": op8_jaccard_join}
