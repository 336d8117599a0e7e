"""Token counts from flat token files without an index, by a scan for end-of-document ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .binary_files import read_binary, write_binary
from .common import bounded_batches, documents, new_folder, stage, text_slices

RANKS = "byte_bpe_50k.tiktoken"
END_ID = 50256                # free in the rank file: ends a document
DOCS_PER_FILE = 10_000        # documents per token file: a file is read as one row
BLOCK = 1 << 20               # tokens searched at once
DTYPE = np.dtype("<u2")
KEY_IDS, KEY_BITS = 5, 13     # a key before a document: five digits of 13 bits, all below END_ID
NO_KEY = 1 << KEY_BITS        # first digit of a NULL key


def key_ids(key: int | None) -> np.ndarray:
    """A 64-bit key as ids."""
    if key is None:
        return np.array([NO_KEY] + [0] * (KEY_IDS - 1), DTYPE)
    key %= 1 << 64
    return np.array([key >> KEY_BITS * i & (1 << KEY_BITS) - 1 for i in range(KEY_IDS)], DTYPE)


def keys_at(ids: np.ndarray, starts: np.ndarray) -> list[int | None]:
    """Keys of the documents that begin at ``starts``; NULL where too few ids are left."""
    inside = starts + KEY_IDS <= len(ids)
    digits = ids[np.where(inside, starts, 0)[:, None] + np.arange(KEY_IDS)] if inside.any() else np.zeros((len(starts), KEY_IDS), DTYPE)
    value = np.zeros(len(starts), np.uint64)
    for i in range(KEY_IDS):
        value |= digits[:, i].astype(np.uint64) << np.uint64(KEY_BITS * i)
    known = inside & (digits[:, 0] < NO_KEY)
    return [v if k else None for v, k in zip(value.view(np.int64).tolist(), known)]


def load_ranks(path: str | None = None) -> tuple[str, dict[bytes, int]]:
    """Split pattern and ranks of a byte-level vocabulary, read on the driver."""
    import base64

    import public_tokenizers

    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return public_tokenizers.PATTERN, {
            base64.b64decode(a): int(b) for a, b in map(bytes.split, file.read().splitlines())}


_ENCODINGS: dict = {}


def write_token_files(df: DataFrame, path: str, vocabulary: tuple[str, dict[bytes, int]] | None = None,
                      key: str | None = "doc_id", text: str = "text", docs_per_file: int = DOCS_PER_FILE) -> None:
    """Encode whole texts and write flat files of unsigned 16-bit ids, each document ended by END_ID.

    Nothing is shuffled: documents lie as they are read. With a ``key`` column (a long), each document begins
    with KEY_IDS ids that hold it. A NULL text is an empty document. The writer's separator is the end id.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    pattern, ranks = vocabulary or load_ranks()
    if max(ranks.values()) >= END_ID:
        raise ValueError("the end id is taken")
    shared = spark.sparkContext.broadcast((pattern, ranks))  # a vocabulary: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        if "own" not in _ENCODINGS:
            pat, table = shared.value
            _ENCODINGS["own"] = tiktoken.Encoding("own", pat_str=pat, mergeable_ranks=table, special_tokens={})
        encode = _ENCODINGS["own"].encode_ordinary
        for batch, texts in text_slices(batches, "text"):
            heads = [key_ids(k).tobytes() for k in batch.column(1).to_pylist()] if key else [b""] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h + np.array(encode(t), DTYPE).tobytes() for h, t in zip(heads, texts)], pa.binary())],
                names=["ids"])

    columns = [F.col(text).alias("text"), *([F.col(key).cast("long").alias("key")] if key else [])]
    write_binary(df.select(*columns).mapInArrow(run, "ids binary"), "ids", path, DTYPE.type(END_ID).tobytes(),
                 most_rows=docs_per_file)


def scan_blocks(end_id: int, dtype: np.dtype, block: int, keyed: bool):
    """A task that lists, per (name, content) and block: the places of end ids, and the keys of what follows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column(0)[row].as_py()
                ids = np.frombuffer(batch.column(1)[row].as_buffer(), dtype)
                first = keys_at(ids, np.zeros(1, int)) if keyed else [None]
                for at in range(0, len(ids), block):
                    ends = np.flatnonzero(ids[at:at + block] == end_id)
                    after = keys_at(ids, ends + at + 1) if keyed else [None] * len(ends)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([at // block], pa.int32()),
                         pa.array([ends.astype(np.int32)], pa.list_(pa.int32())),
                         pa.array([after], pa.list_(pa.int64())), pa.array(first if at == 0 else [None], pa.int64())],
                        names=["name", "block", "ends", "after", "first_key"])

    return run


def count_tokens(spark: SparkSession, path: str, end_id: int = END_ID, dtype: np.dtype = DTYPE,
                 block: int = BLOCK, keyed: bool = True) -> DataFrame:
    """Tokens of every document in flat token files: key, position (over all files by name), n_tokens.

    Neither the end id nor the ids of the key are counted. Each block is searched on its own. The piece of a
    document before a block is found with a prefix scan: the running maximum of where a document begins
    before the block, and the key there. Positions come from running sums of the ends per block and file.

    Ids after the last end of a file belong to no finished document and give no row; an empty folder gives
    no rows. A file is one row, so files are kept far below 2 GB. Without keys, key is NULL.
    """
    blocks = stage(read_binary(spark, path).select("name", "content").mapInArrow(
        scan_blocks(end_id, dtype, block, keyed),
        "name string, block int, ends array<int>, after array<long>, first_key long"), "blocks")
    start = F.col("block").cast("long") * block
    before = Window.partitionBy("name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    following = F.when(F.size("ends") > 0, F.struct(
        (start + F.array_max("ends") + 1).alias("at"), F.element_at("after", -1).alias("key")))
    carried = blocks.select(
        "name", "block", "ends", "after",
        F.coalesce(F.max(following).over(before), F.struct(F.lit(0).cast("long").alias("at"), F.first("first_key").over(
            Window.partitionBy("name").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)).alias("key"))).alias("open"),
        F.coalesce(F.sum(F.size("ends").cast("long")).over(before), F.lit(0)).alias("ends_before"))
    # One row per file: the only scan over everything.
    files = blocks.groupBy("name").agg(F.sum(F.size("ends").cast("long")).alias("n_docs")).select(
        "name", F.coalesce(F.sum("n_docs").over(
            Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("docs_before"))
    # Beginnings and keys of the documents that end in the block: what was open, then what follows each end.
    begins = F.concat(F.array(F.col("open.at")), F.transform("ends", lambda e: start + e + 1))
    keys = F.concat(F.array(F.col("open.key")), F.col("after"))
    ended = carried.join(files, "name").select(
        (F.col("docs_before") + F.col("ends_before")).alias("base"), start.alias("start"),
        F.posexplode(F.arrays_zip(F.col("ends"), F.slice(begins, 1, F.size("ends")).alias("begins"),
                                  F.slice(keys, 1, F.size("ends")).alias("keys"))).alias("k", "doc"))
    return ended.select(
        F.col("doc.keys").alias("key"), (F.col("base") + F.col("k")).alias("position"),
        (F.col("start") + F.col("doc.ends") - F.col("doc.begins") - (KEY_IDS if keyed else 0)).alias("n_tokens"))


def op3_token_counts(spark, sf_dir):
    """Token count of every document, read back from flat token files."""
    path = new_folder(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path)
    return count_tokens(spark, path).select(F.col("key").alias("doc_id"), "n_tokens")


QUERIES = {"op3_token_counts": op3_token_counts}
