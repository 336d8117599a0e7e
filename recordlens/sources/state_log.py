"""The state of fetch windows as an append-only log: changes are committed by number, the newest one of a key counts."""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import commits


@dataclass(frozen=True)
class StateLog:
    """States of ``key`` under ``root``. A commit holds only rows that differ from the state it was made from."""

    root: str
    schema: T.StructType
    key: str

    def version(self, spark: SparkSession) -> int:
        return commits.latest(spark, f"{self.root}/commits")

    def history(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """All committed rows with their ``version``, up to a given one."""
        numbers = [v for v in commits.versions(spark, f"{self.root}/commits") if version is None or v <= version]
        found = None
        for number in numbers:
            path = commits.read(spark, f"{self.root}/commits", number)["path"]
            part = spark.read.schema(self.schema).parquet(f"{self.root}/{path}").withColumn("version", F.lit(number))
            found = part if found is None else found.unionByName(part)
        empty = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType())])
        return spark.createDataFrame([], empty) if found is None else found

    def states(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The newest row of each key, with the version that brought it."""
        rest = [c for c in self.schema.fieldNames() if c != self.key]
        newest = F.max_by(F.struct(*rest, "version"), "version").alias("s")
        return self.history(spark, version).groupBy(self.key).agg(newest).select(self.key, "s.*")

    def commit(self, rows: DataFrame, seen: int) -> int:
        """Append the rows that change the states of version ``seen``; the new version, or ``seen`` if none does.

        Raises ``commits.LostRace`` if another writer has committed since ``seen``: the caller reads again and decides anew.
        Keys are unique in ``rows``.
        """
        spark = rows.sparkSession
        if self.version(spark) != seen:
            raise commits.LostRace(f"{self.root} has gone beyond version {seen}")
        columns = self.schema.fieldNames()
        now = rows.select(*columns)
        changed = now.exceptAll(self.states(spark, seen).select(*columns))
        path = f"changes/{uuid.uuid4().hex}"
        changed.write.parquet(f"{self.root}/{path}")
        if spark.read.schema(self.schema).parquet(f"{self.root}/{path}").isEmpty():
            return seen
        commits.publish(spark, f"{self.root}/commits", seen + 1, {"path": path})
        return seen + 1
