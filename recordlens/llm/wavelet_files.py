"""Token ids in compressed wavelet-matrix files with access, rank and select."""

from __future__ import annotations

import json
import math
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .binary_files import read_binary, write_binary
from .common import SLICE_CHARS, bounded_batches, documents, input_bytes, new_folder, stage, text_slices

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
MAGIC = b"WVM2"
TASK_TEXT_BYTES = 16_000_000  # text per writing task, roughly
MOST_TASKS = 20_000           # writing tasks: with more text each writes more shards
SHARD_TOKENS = 1 << 21        # tokens per matrix and file: bounds a task's memory
PLANE_BLOCK = 1 << 16         # bits of a plane that are compressed together, with a stored rank
LOOKUP_ROWS = 100_000         # answers of a lookup per batch
LOOKUP_BITS = 17              # positions asked of a shard at once: 2**17 at most
CACHE_WORDS = 1_000_000       # words whose ids a worker remembers, in 40 bytes each
KEPT_WORDS = 800_000          # words it keeps when there are more


class Plane:
    """Bits in blocks of PLANE_BLOCK, with the ones before each block; a packed block is opened when it is first needed."""

    def __init__(self, n: int, ranks: np.ndarray, blocks: list[bytes], packed: bool = True) -> None:
        self.n, self.ranks, self.blocks, self.packed = n, ranks, blocks, packed
        self.opened: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ones: np.ndarray) -> Plane:
        raw = np.packbits(ones, bitorder="little")
        step = PLANE_BLOCK // 8
        blocks = [raw[at:at + step].tobytes() for at in range(0, len(raw), step)]
        counts = [int(np.bitwise_count(np.frombuffer(b, np.uint8)).sum()) for b in blocks]
        return cls(len(ones), np.cumsum([0, *counts], dtype=np.int64), blocks, packed=False)

    def block(self, i: int) -> np.ndarray:
        if i not in self.opened:
            raw = self.blocks[i]
            if self.packed:
                import zstandard

                raw = zstandard.ZstdDecompressor().decompress(raw)
            self.opened[i] = np.frombuffer(raw, np.uint8)
        return self.opened[i]

    def bits(self) -> np.ndarray:
        """All bits, as booleans."""
        raw = np.concatenate([self.block(i) for i in range(len(self.blocks))]) if self.blocks else np.empty(0, np.uint8)
        return np.unpackbits(raw, count=self.n, bitorder="little").view(bool)

    @staticmethod
    def _by_block(blocks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each block with the places that ask for it."""
        order = np.argsort(blocks, kind="stable")
        found, first = np.unique(blocks[order], return_index=True)
        yield from zip(found.tolist(), np.split(order, first[1:]))

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position: those before its block and those before it in the block."""
        out, inside = self.ranks[at // PLANE_BLOCK], np.flatnonzero(at % PLANE_BLOCK)
        for i, places in self._by_block(at[inside] // PLANE_BLOCK):
            raw, bit = self.block(i), at[inside[places]] % PLANE_BLOCK
            sums = np.concatenate([[0], np.cumsum(np.bitwise_count(raw), dtype=np.int64)])
            last = np.append(raw, 0)[bit // 8] & ((1 << bit % 8) - 1)
            out[inside[places]] += sums[bit // 8] + np.bitwise_count(last)
        return out

    def bit(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), bool)
        for i, places in self._by_block(at // PLANE_BLOCK):
            bit = at[places] % PLANE_BLOCK
            out[places] = self.block(i)[bit // 8] >> (bit % 8).astype(np.uint8) & 1
        return out

    def find(self, one: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th ones or zeros (from 0), which must exist."""
        ranks = self.ranks if one else np.minimum(np.arange(len(self.ranks)) * PLANE_BLOCK, self.n) - self.ranks
        of, out = np.searchsorted(ranks, k, "right") - 1, np.empty(len(k), np.int64)
        for i, places in self._by_block(of):
            ones = np.unpackbits(self.block(i), count=min(PLANE_BLOCK, self.n - i * PLANE_BLOCK), bitorder="little")
            out[places] = i * PLANE_BLOCK + np.flatnonzero(ones == one)[k[places] - ranks[i]]
        return out


class WaveletMatrix:
    """Bit planes of a sequence, highest bit first, each followed by a stable partition into zeros and ones."""

    def __init__(self, n: int, planes: list[Plane], zeros: list[int]) -> None:
        self.n, self.planes, self.zeros = n, planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max(initial=0)).bit_length())
        planes, zeros, rest = [], [], ids
        for level in range(width - 1, -1, -1):
            ones = (rest >> level & 1).astype(bool)
            planes.append(Plane.build(ones))
            zeros.append(int(len(ones) - np.count_nonzero(ones)))
            rest = np.concatenate([np.compress(~ones, rest), np.compress(ones, rest)])
        return cls(len(ids), planes, zeros)

    def accesses(self, at: np.ndarray) -> np.ndarray:
        """The ids at positions."""
        at = np.asarray(at, np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.n):
            raise IndexError("a position is outside the sequence")
        value = np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.bit(at), plane.ones_before(at)
            at = np.where(bit, zeros + ones, at - ones)
            value = value << 1 | bit
        return value

    def access(self, at: int) -> int:
        return int(self.accesses(np.array([at]))[0])

    def _ends(self, value: int, ends: np.ndarray) -> tuple[int, np.ndarray]:
        """Where the occurrences of ``value`` begin after the last partition, and where those before each end stop."""
        at = np.append(0, ends).astype(np.int64)
        if value < 0 or value >> len(self.planes):
            return 0, np.zeros(len(ends), np.int64)
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.ones_before(at)
            at = zeros + ones if value >> (len(self.planes) - 1 - level) & 1 else at - ones
        return int(at[0]), at[1:]

    def ranks(self, value: int, ends: np.ndarray) -> np.ndarray:
        """Occurrences of an id before each of the positions."""
        low, high = self._ends(value, np.clip(ends, 0, self.n))
        return high - low

    def rank(self, value: int, end: int) -> int:
        return int(self.ranks(value, np.array([end]))[0])

    def selects(self, value: int, ks: np.ndarray) -> np.ndarray:
        """Positions of the k-th occurrences (from 0) of an id, which must exist."""
        low, _ = self._ends(value, np.empty(0, np.int64))
        at = low + np.asarray(ks, np.int64)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = self.planes[level].find(bit, at - self.zeros[level] if bit else at)
        return at

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence; -1 if there are fewer."""
        return int(self.selects(value, np.array([k]))[0]) if 0 <= k < self.rank(value, self.n) else -1

    def to_array(self) -> np.ndarray:
        """The whole sequence: partitions undone from the last plane to the first."""
        rest = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = self.planes[level].bits()
            out = np.empty_like(rest)
            out[np.flatnonzero(~ones)] = rest[:self.zeros[level]]
            out[np.flatnonzero(ones)] = rest[self.zeros[level]:] | (1 << (len(self.planes) - 1 - level))
            rest = out
        return rest


def pack_shard(part: int, shard: int, keys: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard: header, document keys and lengths, ranks before each block of each plane, blocks compressed one by one.

    Begins with its own length.
    """
    import zstandard

    matrix = WaveletMatrix.build(ids)
    press = zstandard.ZstdCompressor(level=1).compress
    known = np.array([k is not None for k in keys], bool)
    blocks = [press(b) for plane in matrix.planes for b in plane.blocks]
    blobs = [press(np.packbits(known).tobytes()),
             press(np.array([k if k is not None else 0 for k in keys], "<i8").tobytes()),
             press(np.asarray(lengths, "<i8").tobytes()),
             press(np.concatenate([plane.ranks for plane in matrix.planes]).astype("<i8").tobytes()),
             press(np.array([len(b) for b in blocks], "<i8").tobytes())]
    head = json.dumps({"part": part, "shard": shard, "n": matrix.n, "docs": len(keys), "zeros": matrix.zeros,
                       "blobs": [len(b) for b in blobs]}).encode()
    body = struct.pack("<4sI", MAGIC, len(head)) + head + b"".join(blobs) + b"".join(blocks)
    return struct.pack("<Q", len(body)) + body


class Shard(NamedTuple):
    part: int
    shard: int
    keys: list
    lengths: np.ndarray
    matrix: WaveletMatrix


def unpack_shards(content: memoryview) -> Iterator[Shard]:
    """The shards of a file. Blocks of the planes stay compressed until they are needed."""
    import zstandard

    at = 0
    while at + 8 <= len(content):
        (size,) = struct.unpack_from("<Q", content, at)
        body = content[at + 8:at + 8 + size]
        at += 8 + size + 1  # the writer's separator follows
        magic, length = struct.unpack_from("<4sI", body)
        if magic != MAGIC:
            raise ValueError("not a wavelet file")
        head = json.loads(bytes(body[8:8 + length]))
        parts, place = [], 8 + length
        for size in head["blobs"]:
            parts.append(zstandard.ZstdDecompressor().decompress(bytes(body[place:place + size])))
            place += size
        known = np.unpackbits(np.frombuffer(parts[0], np.uint8), count=head["docs"])
        keys = [k if f else None for k, f in zip(np.frombuffer(parts[1], "<i8").tolist(), known)]
        width, n = len(head["zeros"]), head["n"]
        ranks = np.frombuffer(parts[3], "<i8").reshape(width, -1)
        ends = place + np.cumsum(np.frombuffer(parts[4], "<i8"))
        blocks = [body[a:b] for a, b in zip([place, *ends[:-1].tolist()], ends.tolist())]
        each = len(blocks) // width
        planes = [Plane(n, ranks[i], blocks[i * each:(i + 1) * each]) for i in range(width)]
        yield Shard(head["part"], head["shard"], keys, np.frombuffer(parts[2], "<i8"),
                    WaveletMatrix(n, planes, head["zeros"]))


LETTER, DIGIT, BLANK, MARKS = 0, 1, 2, 3


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, MARKS, np.uint8)
    kinds[list(b"abcdefghijklmnopqrstuvwxyz")] = LETTER
    kinds[128:] = LETTER
    kinds[list(b"0123456789")] = DIGIT
    kinds[list(b" \t\n\v\f\r")] = BLANK
    return kinds


BYTE_KIND = _byte_kinds()
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)


class WordCache:
    """Ids of texts from ids of their pre-tokens, which do not interact; each is encoded once and remembered.

    Texts of Latin letters are cut into pre-tokens all at once on their bytes, as the tokenizer's own pattern
    does, and known by a 64-bit hash of their bytes. Other texts, and those that may hold the tokenizer's
    special tokens, go to the tokenizer whole.
    """

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.keys, self.codes = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.up = self.down = np.ones(1, np.uint64)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    @staticmethod
    def unusual(raw: np.ndarray) -> np.ndarray:
        """Places of bytes that are neither ASCII nor a Latin-1 letter, or that begin ``<|``."""
        after = np.append(raw[1:], 0)
        lead = raw >= 0xC0
        wrong = lead & ((raw != 0xC3) | (after == 0x97) | (after == 0xB7))
        return np.flatnonzero(wrong | ((raw == 60) & (after == 124)))

    @staticmethod
    def lower(raw: np.ndarray) -> np.ndarray:
        low = LOWER_ASCII[raw]
        behind = np.flatnonzero(raw[:-1] == 0xC3) + 1
        behind = behind[low[behind] < 0x9F]
        low[behind] += 0x20
        return low

    @staticmethod
    def cut(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens: letters, single digits, runs of marks, English contractions."""
        kind = BYTE_KIND[low]
        before = np.concatenate([[np.uint8(BLANK)], kind[:-1]])
        start = (kind != BLANK) & ((kind != before) | (kind == DIGIT))
        for i in np.flatnonzero((low == 39) & (before != MARKS)).tolist():
            tail = low[i + 1:i + 3].tobytes()
            size = 2 if tail[:1] in (b"s", b"t", b"m", b"d") else 3 if tail in (b"re", b"ve", b"ll") else 0
            if size:
                start[i + 1] = False
                if i + size < len(low) and kind[i + size] == LETTER:
                    start[i + size] = True
        closed = start | ((kind == BLANK) & (before != BLANK))
        ends = np.append(np.flatnonzero(closed & (before != BLANK)), len(low))
        starts = np.flatnonzero(start)
        return starts, ends[:len(starts)]

    def hashes(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(low):
            size = 1 << (len(low) + 1).bit_length()
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.up, self.down = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, f, np.uint64)]))
                                  for f in (BASE, inverse))
        total = np.empty(len(low) + 1, np.uint64)
        total[0] = 0
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.up[:len(low)], out=total[1:])
        value = (total[ends] - total[starts]) * self.down[starts]
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(32)) ^ (ends - starts).astype(np.uint64)

    def learn(self, keys: np.ndarray, words: list[bytes], forget: bool = True) -> None:
        """Encode new pre-tokens in one call; each ends with one id that ends a word."""
        found = self.ids(b" ".join(words).decode())
        cuts = np.flatnonzero(self.ends_word[found])
        if len(cuts) != len(words):
            raise ValueError("a pre-token is not one word")
        if forget and len(self.keys) + len(keys) > CACHE_WORDS:
            # Frequent words come early: those keep their places.
            old = self.codes < KEPT_WORDS
            self.keys, self.codes = self.keys[old], self.codes[old]
            self.sizes = self.sizes[:KEPT_WORDS]
            self.flat = self.flat[:int(self.sizes.sum())]
        codes = len(self.sizes) + np.arange(len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.codes = np.insert(self.keys, at, keys), np.insert(self.codes, at, codes)
        self.flat = np.concatenate([self.flat, found])
        self.sizes = np.concatenate([self.sizes, np.diff(cuts, prepend=-1)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, each text with END_ID at its end, and the number of ids per text."""
        parts = [t.encode() for t in texts]
        bounds = np.cumsum([len(p) + 1 for p in parts])
        raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        alone = np.unique(np.searchsorted(bounds, self.unusual(raw), "right")).tolist()
        if alone:
            own = {i: self.ids(texts[i]) for i in alone}
            for i in alone:
                parts[i] = b""
            bounds = np.cumsum([len(p) + 1 for p in parts])
            raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        low = self.lower(raw)
        starts, ends = self.cut(low)
        keys, first, at = np.unique(self.hashes(low, starts, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            data = low.tobytes()
            self.learn(keys[new], [data[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            place = np.searchsorted(self.keys, keys)
            lost = self.keys[np.minimum(place, len(self.keys) - 1)] != keys
            if lost.any():  # the cache was cut back: learn what this slice still needs
                self.learn(keys[lost], [data[a:b] for a, b in zip(
                    starts[first[lost]].tolist(), ends[first[lost]].tolist())], forget=False)
                place = np.searchsorted(self.keys, keys)
        code = self.codes[place][at] if len(keys) else np.empty(0, np.int64)
        counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
        # One more word per text: the end id, which lies behind all others.
        last = np.cumsum(counts + 1) - 1
        codes = np.insert(code, np.cumsum(counts), len(self.sizes))
        sizes = np.append(self.sizes, 1)
        flat = np.append(self.flat, np.uint32(END_ID))
        from_ = np.cumsum(sizes) - sizes
        take = sizes[codes]
        stop = np.cumsum(take)
        within = np.arange(int(stop[-1])) - np.repeat(stop - take - from_[codes], take)
        ids, lengths = flat[within], np.diff(stop[last], prepend=0)
        if alone:
            cut = np.split(ids, np.cumsum(lengths)[:-1])
            for i in alone:
                cut[i] = np.append(own[i], np.uint32(END_ID))
            ids, lengths = np.concatenate(cut), np.fromiter(map(len, cut), np.int64, len(cut))
        return ids, lengths


_CACHES: dict[str, WordCache] = {}


def write_wavelet_files(df: DataFrame, path: str, tokenizer_json: str | None = None, order: str = "doc_id",
                        text: str = "text") -> None:
    """Encode whole texts, append END_ID to each, and write wavelet shards, one a file, in ranges of ``order``.

    NULL texts are empty documents. Documents lie in ascending order of ``order``, a long (NULL first);
    equal keys in any order: their rows are ranged by a hash of the text as well, so that one key may be many rows.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    if tokenizer_json is None:
        import public_tokenizers

        with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
            tokenizer_json = file.read()
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary: fixed size
    tasks = min(MOST_TASKS, max(1, math.ceil(input_bytes(df, text) / TASK_TEXT_BYTES)))
    place = [F.col("_order").asc_nulls_first(), F.xxhash64("text")]
    ordered = df.select(F.col(order).cast("long").alias("_order"), F.col(text).alias("text")).repartitionByRange(
        tasks, *place).sortWithinPartitions("_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary = shared.value
        if vocabulary not in _CACHES:
            _CACHES[vocabulary] = WordCache(vocabulary)
        part, number, keys, lengths, ids, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def shard() -> pa.RecordBatch:
            packed = pack_shard(part, number, keys, np.concatenate(lengths), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["shard"])

        for batch, texts in text_slices(batches, "text", 2 * SLICE_CHARS):
            found, sizes = _CACHES[vocabulary].encode(texts)
            ids.append(found.astype(np.uint16) if int(found.max()) < 1 << 16 else found)
            lengths.append(sizes)
            keys += batch.column(0).to_pylist()
            held += len(found)
            if held >= SHARD_TOKENS:
                yield shard()
                number, keys, lengths, ids, held = number + 1, [], [], [], 0
        if keys:
            yield shard()

    write_binary(ordered.mapInArrow(run, "shard binary"), "shard", path, b"\n", most_rows=1)


def _shards(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, int, Shard]]:
    for batch in batches:
        for row in range(batch.num_rows):
            for shard in unpack_shards(memoryview(batch.column(column)[row].as_buffer())):
                yield batch, row, shard


def _batch(types: list[pa.DataType], names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document in the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, n_end_ids.

    The ids come out of the wavelet matrices; how often a document holds END_ID is the difference of two ranks. Starts
    are running sums inside a shard plus prefix sums over the shards of a task and over the tasks, of which there are
    at most MOST_TASKS. An empty folder gives no rows.
    """
    names = ["part", "shard", "doc_id", "local_start", "n_tokens", "ids_crc32", "n_end_ids"]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (part, number, keys, lengths, matrix) in _shards(batches):
            ids, ends = matrix.to_array().astype("<u4"), np.cumsum(lengths)
            raw, starts = memoryview(ids.tobytes()), ends - lengths
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield _batch(types, names, [part] * len(keys), [number] * len(keys), keys, starts, lengths, sums,
                         np.diff(matrix.ranks(END_ID, ends), prepend=0))

    rows = stage(read_binary(spark, path).select("content").mapInArrow(
        run, "part int, shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long, n_end_ids long"),
        "wavelet-rows")
    shards = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    inside = shards.select("part", "shard", F.coalesce(F.sum("n").over(
        Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("inside"))
    tasks = shards.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(inside.join(tasks, "part"), ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("inside") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32",
        "n_end_ids")


def count_ids(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """id, n: occurrences of each of the ids (repeated ones once) over all shards, by rank. Ids that no shard holds have 0."""
    wanted = sorted(set(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, shard in _shards(batches):
            yield _batch([pa.int64()] * 2, ["id", "n"], wanted, [shard.matrix.rank(i, shard.matrix.n) for i in wanted])

    counted = read_binary(spark, path).select("content").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))
    return spark.createDataFrame([(i,) for i in wanted], "id long").join(counted, "id", "left").select(
        "id", F.coalesce("n", F.lit(0)).alias("n"))


def find_ids(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """id, doc_id, offset (in the document): one row per occurrence of one of the ids, by select, some at a time."""
    wanted = sorted(set(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (_, _, keys, lengths, matrix) in _shards(batches):
            ends = np.cumsum(lengths)
            for value in wanted:
                n = matrix.rank(value, matrix.n)
                for k in range(0, n, LOOKUP_ROWS):
                    at = matrix.selects(value, np.arange(k, min(k + LOOKUP_ROWS, n)))
                    doc = np.searchsorted(ends, at, "right")
                    yield _batch([pa.int64()] * 3, ["id", "doc_id", "offset"], np.full(len(at), value),
                                 [keys[d] for d in doc.tolist()], at - (ends - lengths)[doc])

    return read_binary(spark, path).select("content").mapInArrow(run, "id long, doc_id long, offset long")


def ids_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id, offset, id: the id at each (doc_id, offset) of ``wanted``, by access.

    A repeated request is answered once; a key that several documents share is answered for each. NULL keys, NULL
    offsets and offsets outside the document give no row. Requests go to the shards that hold their documents, at most
    2**LOOKUP_BITS positions at a time.
    """
    names = ["part", "shard", "doc_id", "start", "n"]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (part, number, keys, lengths, _) in _shards(batches):
            yield _batch([pa.int32(), pa.int32(), *[pa.int64()] * 3], names, [part] * len(keys), [number] * len(keys),
                         keys, np.cumsum(lengths) - lengths, lengths)

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, shard in _shards(batches):
            yield _batch([pa.int32(), pa.int32(), pa.binary()], ["part", "shard", "content"], [shard.part], [shard.shard],
                         [batch.column(0)[row].as_py()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, shard in _shards(batches, 2):
            at = np.array(batch.column(3)[row].as_py(), np.int64)
            yield _batch([pa.int32(), pa.int32(), pa.int64(), pa.int64()], ["part", "shard", "at", "id"],
                         [shard.part] * len(at), [shard.shard] * len(at), at, shard.matrix.accesses(at))

    files = read_binary(spark, path).select("content")
    places = files.mapInArrow(listed, "part int, shard int, doc_id long, start long, n long")
    asked = wanted.select(F.col("doc_id").cast("long"), F.col("offset").cast("long")).distinct()
    located = stage(asked.join(places, "doc_id").filter("offset >= 0 AND offset < n").select(
        "doc_id", "offset", "part", "shard", (F.col("start") + F.col("offset")).alias("at")), "wavelet-requests")
    groups = located.groupBy("part", "shard", F.shiftright("at", LOOKUP_BITS).alias("piece")).agg(
        F.collect_list("at").alias("ats"))
    answers = files.mapInArrow(bodies, "part int, shard int, content binary").join(groups, ["part", "shard"]).select(
        "part", "shard", "content", "ats").mapInArrow(run, "part int, shard int, at long, id long")
    return located.join(answers, ["part", "shard", "at"]).select("doc_id", "offset", "id")


def op7_wavelet_tokens(spark, sf_dir):
    """Every document encoded, written to wavelet files and read back."""
    path = new_folder(spark, "wavelet-files")
    write_wavelet_files(documents(spark, sf_dir), path)
    return read_documents(spark, path)


QUERIES = {"op7_wavelet_tokens": op7_wavelet_tokens}
