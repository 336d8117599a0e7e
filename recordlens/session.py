"""Session defaults and lineage cutting."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "recordlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    On a cluster the submitter's own settings win; only what is unset is filled in.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_folder(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``, or else a part of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging").rstrip("/")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over many tasks: a table of few row groups would go through long rules in as few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to Parquet in the shared folder and read it back from there.

    Used where several branches read one expensive intermediate, or where a row-to-partition
    assignment has to stay put. Readers keep column pruning and pushed filters.
    """
    path = f"{staging_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
