"""Binary files through Spark's own writers and readers, so that any file system Spark knows will do.

The text writer puts the bytes of a string column and a separator into a file. A binary column cast to
string keeps its bytes, so a row becomes a stretch of a file, and the writer's commit protocol covers
lost executors and repeated tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_binary(df: DataFrame, column: str, path: str, separator: bytes, compression: str = "none",
                 most_rows: int = 0) -> None:
    """Each row's bytes, each followed by ``separator``: one file per partition, or several of ``most_rows`` rows."""
    (df.select(F.col(column).cast("string").alias("value")).write
     .option("lineSep", separator.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("compression", compression).option("maxRecordsPerFile", most_rows).text(path))


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """part (place of the file in the writer's order), name, content: one row per file with any bytes."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select(
        F.regexp_extract(name, r"part-(\d+)", 1).cast("int").alias("part"), name.alias("name"), "content")
