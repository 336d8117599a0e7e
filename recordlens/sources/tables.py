"""Typed readers. Schemas are pinned; which source is read is always said, never guessed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .. import fixed_values as V
from .. import schemas as S
from ..functions.address import derive_city, street_only
from ..functions.dates import portal_date
from ..functions.text import squish, to_int, zip5
from ..operators.geocode import one_per_query
from ..operators.select import dedupe_prefer, desc
from .csv_records import read_csv

FORMATS = ("csv", "parquet", "orc", "json")


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The columns of ``schema``. CSV needs a header and binds by name; other columns are left out, values that do
    not fit their type are NULL. Quoted fields may hold line breaks, and a file is still read by many tasks."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    # With a schema the reader would bind columns by position; here they are taken by name.
    raw = read_csv(spark, path)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or an empty one of the same shape when the path does not exist."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def type_export(raw: DataFrame) -> DataFrame:
    """Batch export in the canonical shape: fields it never carried are NULL."""
    follow_up = F.col("process_description") == V.FOLLOW_UP_PROCESS
    null = F.lit(None).cast("string")
    typed = raw.select(
        F.col("facility_id").cast("string").alias("facility_id"),
        squish("restaurant_name").alias("restaurant_name"),
        squish("address").alias("address"),
        zip5(F.col("zip_code").cast("string")).alias("zip5"),
        portal_date(F.col("inspection_date").cast("string")).alias("inspection_date"),
        F.col("score").cast("int").alias("score"),
        F.when(follow_up, V.FOLLOW_UP).when(~follow_up, V.ROUTINE).alias("purpose"),
        follow_up.alias("is_followup"),
        null.alias("inspection_type"), null.alias("program_name"),
        null.alias("permit_id"), null.alias("inspection_id"),
        F.lit(V.BATCH_SOURCE).alias("source"),
    )
    return typed.withColumns({
        "city": derive_city("address", "restaurant_name"), "street": street_only("address"),
    }).select(*S.INSPECTIONS.fieldNames())


def read_export(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return type_export(read_table(spark, path, S.RAW_EXPORT, fmt))


def read_inspections(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The canonical table."""
    return read_table(spark, path, S.INSPECTIONS, fmt).withColumn(
        "restaurant_name", squish("restaurant_name")
    )


def load_inspections(spark: SparkSession, path: str, source: str, fmt: str = "parquet") -> DataFrame:
    """Canonical rows from a named source: ``merged`` or ``export``."""
    if source == "merged":
        return read_inspections(spark, path, fmt)
    if source == "export":
        return read_export(spark, path, fmt)
    raise ValueError("source must be 'merged' or 'export'")


def type_portal(raw: DataFrame) -> DataFrame:
    """Portal records with a date and a whole-number score, newest version of each record.

    Inspectors' free text and visit times stop here: only listed columns are carried on.
    """
    newest = dedupe_prefer(
        raw, ["inspectionID"],
        [desc("scraped_at"), *[F.col(c).asc_nulls_last() for c in V.PORTAL_COLUMNS[1:]]],
    )
    return newest.select(
        "inspectionID", "permitID", "inspectionType", "programName", "purpose",
        squish("establishmentName").alias("establishmentName"),
        squish("addressLine1").alias("addressLine1"), "city", "zip", "permitType",
        portal_date("inspectionDate").alias("date"), to_int("score").alias("score"),
    )


def read_portal(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return type_portal(read_table(spark, path, S.PORTAL_RAW, fmt))


def read_geocode_cache(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return one_per_query(read_optional(spark, path, S.GEOCODE_CACHE, fmt))


def read_legacy_geocodes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, S.LEGACY_GEOCODES, fmt)
