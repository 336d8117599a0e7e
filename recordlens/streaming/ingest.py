"""Idempotent ingest of landed answer pages.

Bronze is append-only: every micro-batch overwrites its own ``batch_id`` folder, so a batch
that is replayed after a failure leaves the same files. Which version of a record counts is
decided when bronze is read, by a shuffle on the record id; no growing state is held and no
snapshot is rewritten per batch. ``compact`` folds bronze into one new snapshot when wanted.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as V
from .. import schemas as S
from ..operators.select import newest_version
from ..sources.pages import classify_pages, page_records, quarantined, request_log
from ..sources.sinks import utc_stamp
from ..sources.tables import read_optional

RECORDS, LOG, FAULTS = "records", "request_log", "quarantine"


def _write_batch(target: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept for the three writes, so that the landing files are read and parsed once.
        stamped = classify_pages(batch).withColumn("scraped_at", utc_stamp()).persist()
        for name, frame in (
            (RECORDS, page_records(stamped, "window", "scraped_at")),
            (LOG, request_log(stamped, F.col("scraped_at"))),
            (FAULTS, quarantined(stamped, "window", "start", "scraped_at")),
        ):
            frame.write.mode("overwrite").parquet(f"{target}/{name}/batch_id={batch_id}")
        stamped.unpersist()

    return write


def ingest_pages(
    spark: SparkSession, landing: str, target: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Take in every page landed since the last run and stop."""
    reader = spark.readStream.schema(S.LANDED_PAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.json(landing)
        .writeStream.foreachBatch(_write_batch(target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_bronze(spark: SparkSession, target: str, name: str = RECORDS) -> DataFrame:
    """All batches of a bronze table with their ``batch_id``; empty before the first one."""
    return read_optional(spark, f"{target}/{name}", S.BRONZE[name])


def current_records(spark: SparkSession, target: str) -> DataFrame:
    """Newest version of every record ingested so far."""
    bronze = read_bronze(spark, target)
    return newest_version(
        bronze, ["inspectionID"], "scraped_at", [F.desc("batch_id"), *V.PORTAL_COLUMNS[1:]]
    )


def compact(spark: SparkSession, target: str, snapshot: str) -> None:
    """Write the current records as a new snapshot; bronze stays as it is."""
    current_records(spark, target).write.mode("errorifexists").parquet(snapshot)
