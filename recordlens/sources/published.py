"""Published documents: one JSON object in order, written by many tasks, and read by what its own header says.

The document is the text of its part files in name order: a header, a row per line as a positional array, and a closing part.
"""

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spread import group_index
from .sinks import json_array_row


@dataclass(frozen=True)
class Document:
    """``header`` without the rows; ``rows`` with a text column per field that the header names, and ``place`` from 0."""

    header: dict
    rows: DataFrame


def write_document(rows: DataFrame, header: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """Write ``rows`` in ``order_by`` (ascending, total) below the one row of ``header``.

    Positions are counted per range, so no task sees all rows; the sort deals them to part files in order, and the
    writer's commit protocol publishes all files or none. All columns of ``rows`` are fields, in their order, but for those
    of ``order_by`` that begin with an underscore.
    """
    fields = [c for c in rows.columns if not (c.startswith("_") and c in order_by)]
    placed = group_index(rows.withColumn("_doc", F.lit(1)), ["_doc"], order_by, "_place", "_size")
    names = F.array(*[F.lit(c) for c in fields]).alias("fields")
    opening = F.to_json(F.struct(*header.columns, names), {"ignoreNullFields": "false"})
    parts = [
        header.select(F.lit(-1).cast("long").alias("place"), F.concat(
            F.regexp_replace(opening, r"\}$", ""), F.lit(',"rows":[')).alias("text")),
        placed.select(F.col("_place").cast("long").alias("place"), F.concat(
            F.when(F.col("_place") > 0, ",").otherwise(""), json_array_row(fields)).alias("text")),
        rows.sparkSession.createDataFrame([((1 << 62), "]}")], "place long, text string"),
    ]
    parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("place").select("text").write.text(path)


def read_document(spark: SparkSession, path: str) -> Document:
    """The header is read first; its ``fields`` say what stands where in a row, whatever their order."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    opening = lines.filter(F.startswith("value", F.lit("{"))).select("value").first()
    if opening is None:
        raise ValueError(f"no document at {path}")
    header = json.loads(opening.value + "]}")
    header.pop("rows")
    body = lines.filter(F.startswith("value", F.lit("[")) | F.startswith("value", F.lit(",[")))
    placed = group_index(body.withColumn("_doc", F.lit(1)), ["_doc"], ["_file", "_at"], "place", "_size")
    cells = F.from_json(F.regexp_replace("value", "^,", ""), "array<string>")
    rows = placed.select("place", cells.alias("_cells")).select(
        "place", *[F.col("_cells")[i].alias(name) for i, name in enumerate(header["fields"])])
    return Document(header, rows)
