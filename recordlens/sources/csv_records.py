"""CSV files of any size read by many tasks, though quoted fields may hold line breaks.

A file is cut into byte ranges, as any text file is. A line begins a record if the quotes before it in its file are even
in number. Ranges count their own quotes, a prefix scan over the ranges gives the state at each start, and lines are
put together from there: nothing but one row per range is ever put in order across a file.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPTIONS = {"nullValue": "NA", "quote": '"', "escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where its byte range starts), at (order inside the range), value, odd (its quotes, modulo 2), cr."""
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).alias("odd"),
        F.endswith("value", F.lit("\r")).alias("cr"))


def _before(lines: DataFrame) -> DataFrame:
    """Adds the odd lines before each line in its range."""
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("before", F.coalesce(F.sum("odd").over(inside), F.lit(0)))


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """One row per byte range: file, block, open (1 if it starts inside quotes), the range and number of the record that
    its first lines continue, and crlf (whether the file's first line ends so)."""
    counted = _before(_lines(spark, path).drop("value")).groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.count_if(F.col("before") % 2 == 0).alias("even_lines"),
        F.count_if(F.col("before") % 2 == 1).alias("odd_lines"), F.min_by("cr", "at").alias("cr"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).withColumn(
        "starts", F.when(F.col("open") == 0, F.col("even_lines")).otherwise(F.col("odd_lines")))
    begun = F.when(F.col("starts") > 0, F.struct(F.col("block"), F.col("starts")))
    return placed.withColumn("owner", F.last(begun, ignorenulls=True).over(earlier)).select(
        "file", "block", "open", F.col("owner.block").alias("owner_block"), F.col("owner.starts").alias("owner_record"),
        F.first("cr").over(Window.partitionBy("file").orderBy("block")).alias("crlf"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, first (whether it is the file's first record) and record (its text) of all records.

    Quotes stand around whole fields and are doubled inside, as RFC 4180 says; a lone quote inside an unquoted field would be
    taken for an opening one. Lines end in LF, or in CRLF if the first one of the file does; then a CRLF inside quotes
    becomes LF too, as in Spark's reader. Empty lines between records are left out. A task holds a range at a time.
    """
    lines = _before(_lines(spark, path).drop("cr")).join(ranges(spark, path), ["file", "block"])
    begins = ((F.col("before") + F.col("open")) % 2 == 0).cast("long")
    so_far = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = lines.withColumn("n", F.sum(begins).over(so_far))
    own = F.col("n") > 0
    gathered = numbered.groupBy(
        "file", F.when(own, F.col("block")).otherwise(F.col("owner_block")).alias("owner"),
        F.when(own, F.col("n")).otherwise(F.col("owner_record")).alias("number"),
    ).agg(F.sort_array(F.collect_list(F.struct("block", "at", F.when(
        F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value")))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return gathered.select(
        "file", ((F.col("owner") == 0) & (F.col("number") == 1)).alias("first"), text.alias("record")).filter("record <> ''")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the CSV files at ``path`` as text, named by the header that each file begins with."""
    names = spark.read.options(header=True, **OPTIONS).csv(path).columns
    places = [f"c{i}" for i in range(len(names))]
    fields = F.from_csv("record", F.lit(", ".join(f"{c} string" for c in places)), OPTIONS)
    parsed = csv_records(spark, path).filter(~F.col("first")).select(fields.alias("r"))
    return parsed.select(*[F.col(f"r.{c}").alias(name) for c, name in zip(places, names)])
