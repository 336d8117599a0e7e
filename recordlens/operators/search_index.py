"""Substring search without scanning: posting lists of letter pairs and triples, the rarest first, then an exact look."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import haystack

SIZES = (2, 3)     # lengths of the parts that are listed
RAREST = 4         # lists that are intersected; the exact look does the rest
PARTS = 256        # folders that the rows are dealt over by id; a search reads those of its candidates


def _grams(text: Column, size: int) -> Column:
    """Distinct runs of ``size`` characters. The pattern moves on by one character a match: to cut a run out by its place
    would walk the text up to there each time."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1)))


@dataclass(frozen=True)
class SearchIndex:
    """An index in ``path`` of rows that ``ident`` names; rows with equal ids are found each."""

    path: str
    ident: str

    def build(self, df: DataFrame, fields: Sequence[str]) -> None:
        """List every run of 2 and 3 characters of the joined, lower-case fields, and store the rows with that text.

        The lists of a folder's rows are one file in order of their run, made by a task of its own: only texts are
        shuffled, never their runs, a long list is cut over all files, and a search reads the pages of its own runs. The
        text counts for the folder too, so that rows with one id are dealt over many.
        """
        rows = df.withColumn("_text", haystack(*fields)).withColumn(
            "_part", F.pmod(F.xxhash64(self.ident, "_text"), F.lit(PARTS)).cast("int"))
        rows.repartitionById(PARTS, "_part").write.partitionBy("_part").parquet(f"{self.path}/rows")
        stored = df.sparkSession.read.parquet(f"{self.path}/rows").select(F.col(self.ident).alias("id"), "_text", "_part")
        grams = F.concat(*[_grams(F.col("_text"), n) for n in SIZES])
        listed = stored.repartitionById(PARTS, "_part").select(F.explode(grams).alias("gram"), "id", "_part")
        listed.sortWithinPartitions("gram", "id").write.parquet(f"{self.path}/lists")
        lists = df.sparkSession.read.parquet(f"{self.path}/lists")
        lists.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).sort("gram").write.parquet(f"{self.path}/grams")

    def candidates(self, spark: SparkSession, wanted: str) -> DataFrame | None:
        """id and _part of the rows that hold the rarest runs of ``wanted``; None if one of its runs occurs nowhere."""
        size = min(max(SIZES), len(wanted))
        runs = {wanted[i:i + size] for i in range(len(wanted) - size + 1)}
        counts = spark.read.parquet(f"{self.path}/grams").filter(F.col("gram").isin(*runs)).orderBy("n", "gram").collect()
        if len(counts) < len(runs):
            return None
        chosen = [r.gram for r in counts[:RAREST]]
        return (spark.read.parquet(f"{self.path}/lists").filter(F.col("gram").isin(*chosen)).groupBy("id", "_part")
                .agg(F.count_distinct("gram").alias("_n")).filter(F.col("_n") == len(chosen)).drop("_n"))

    def find(self, spark: SparkSession, text: str, min_chars: int = V.SEARCH_MIN_CHARS) -> DataFrame:
        """The rows whose fields contain ``text``, ignoring case, as a scan would find them."""
        rows = spark.read.parquet(f"{self.path}/rows")
        wanted = text.strip().lower()
        found = self.candidates(spark, wanted) if len(wanted) >= max(min_chars, min(SIZES)) else None
        if found is None:
            return rows.filter(F.lit(False)).drop("_text", "_part")
        parts = [r["_part"] for r in found.select("_part").distinct().collect()]  # at most PARTS
        near = rows.filter(F.col("_part").isin(parts) if parts else F.lit(False)).filter(F.contains("_text", F.lit(wanted)))
        ids = found.select(F.col("id").alias("_id"), F.col("_part").alias("_in"))
        return near.join(ids, F.col(self.ident).eqNullSafe(F.col("_id")) & (F.col("_part") == F.col("_in")), "left_semi").drop(
            "_text", "_part")
