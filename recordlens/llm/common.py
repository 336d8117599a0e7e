"""Staging, folds and Arrow helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

ARROW_ROWS = 500          # rows per Arrow batch: bounds a Python worker's memory with long texts
SLICE_CHARS = 1_000_000   # characters handled at once inside a task


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to Parquet in the shared folder and read it back: lineage ends, executors may go."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since one row may be a long text."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def fold(column: str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; NULL counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
                most: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches that hold at most ``most`` characters (or one row), with their texts.

    NULL becomes the empty text.
    """
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        start = size = 0
        for i, t in enumerate(texts):
            if i > start and size + len(t) > most:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def input_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BROADCAST_KEYS = 1_000_000  # keys (8 bytes each) that may be broadcast; more are shuffled


def bounded_broadcast(keys: DataFrame) -> DataFrame:
    """``keys`` hinted for broadcast if they are counted to be few enough, else as they are."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def with_fields(fields: list[StructField], more: str) -> StructType:
    """Schema of the fields, whatever their names, and of those that ``more`` declares."""
    return StructType([*fields, *StructType.fromDDL(more).fields])


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """``document``: a struct of all columns but ``text``, so that none clashes with what an operator adds; then ``text``
    and ``more``. ``unpacked`` gives the columns back in their order.
    """
    rest = [_named(c).alias(c) for c in df.columns if c != "text"]
    unused = "_" * (1 + max(map(len, df.columns)))  # a struct needs a field
    return df.select(F.struct(F.lit(True).alias(unused), *rest).alias("document"), "text",
                     *[value.alias(name) for name, value in more.items()])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("text") if c == "text" else F.col("document")[c].alias(c) for c in columns])


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sorted_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal first key in one task, in order of all keys."""
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


def local_forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Star edges (node, smallest node reachable) of the pairs: at most one per node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in list(parent) if (r := find(x)) != x]
