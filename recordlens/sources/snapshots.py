"""Newest versions of records in buckets: an upsert rewrites only buckets that change, readers see one snapshot.

A manifest says for each bucket in which folder its rows lie. Data files are never changed, so a reader that holds a manifest
keeps its snapshot while writers go on; folders that no manifest names any more may be expired.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.select import newest_version
from ..session import materialise
from . import commits

BUCKETS = 64


@dataclass(frozen=True)
class Snapshots:
    """A table of the newest version of each record: ``key`` names it, ``stamp`` its version, ``order_by`` breaks ties.

    Rows with a NULL key are records of one key like others.
    """

    root: str
    schema: T.StructType
    key: str
    stamp: str
    order_by: Sequence[str]
    buckets: int = BUCKETS  # fixed by the first commit

    def manifest(self, spark: SparkSession, version: int | None = None) -> dict:
        """The manifest of a version, by default the newest; an empty one before the first."""
        folder = f"{self.root}/manifests"
        version = commits.latest(spark, folder) if version is None else version
        if not version:
            return {"version": 0, "buckets": self.buckets, "folders": {}, "note": {}}
        return commits.read(spark, folder, version)

    def read(self, spark: SparkSession, manifest: dict | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a snapshot, without any work on versions; of the buckets ``only``, if given."""
        manifest = manifest or self.manifest(spark)
        paths = [p for b, p in manifest["folders"].items() if only is None or int(b) in only]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def upsert(self, incoming: DataFrame, note: dict | None = None) -> DataFrame:
        """Take in rows; one row with the counts before and after: version, n_before, n_incoming (rows), n_new, n_updated,
        n_unchanged (records that stay as they are or arrive as they were), n_after, buckets_rewritten.

        Of equal keys the newest stamp counts, then the order. Only buckets in which a record is new or changed are read whole
        and written anew. A replay changes nothing and commits nothing (unless it brings another ``note``). If
        another writer commits first, ``commits.LostRace`` is raised and the table is as that writer left it.
        """
        spark = incoming.sparkSession
        manifest = self.manifest(spark)
        n_buckets = manifest["buckets"]
        columns = self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(self.key), F.lit(n_buckets)).cast("int")
        rows = materialise(incoming.select(*columns).withColumn("_bucket", bucket))
        arriving = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]  # at most the number of buckets
        old = self.read(spark, manifest, arriving).withColumns({"_old": F.lit(True), "_bucket": bucket})
        both = old.unionByName(rows.withColumn("_old", F.lit(False)))
        newest = newest_version(both, [self.key], self.stamp, [*self.order_by, F.desc("_old")])
        # One pass over the buckets that rows arrive for: is the winner old, and was there an old row?
        known = both.groupBy(F.col(self.key).alias("_key")).agg(F.max("_old").alias("_known"))
        chosen = materialise(newest.join(known, F.col(self.key).eqNullSafe(F.col("_key"))).drop("_key"))
        per_bucket = chosen.groupBy("_bucket").agg(
            F.count_if(~F.col("_known")).alias("new"), F.count_if(F.col("_known") & ~F.col("_old")).alias("updated"),
            F.count_if("_old").alias("kept"), F.count(F.lit(1)).alias("rows")).collect()
        changed = sorted(r["_bucket"] for r in per_bucket if r.new or r.updated)
        version = manifest["version"]
        counts = manifest.get("rows", {})
        folders = dict(manifest["folders"])
        if changed or (note or {}) != manifest["note"]:
            part = f"data/{uuid.uuid4().hex}"
            if changed:
                chosen.filter(F.col("_bucket").isin(changed)).drop("_old", "_known").repartition(
                    "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{part}")
            after = {**counts, **{str(r["_bucket"]): r.rows for r in per_bucket if r["_bucket"] in changed}}
            folders |= {str(b): f"{part}/_bucket={b}" for b in changed}
            version += 1
            commits.publish(spark, f"{self.root}/manifests", version, {
                "version": version, "buckets": n_buckets, "folders": folders, "rows": after, "note": note or {}})
        else:
            after = counts
        n_new, n_updated = sum(r.new for r in per_bucket), sum(r.updated for r in per_bucket)
        n_before, n_after = sum(counts.values()), sum(after.values())
        return rows.agg(F.count(F.lit(1)).alias("n_incoming")).select(
            F.lit(version).alias("version"), F.lit(n_before).cast("long").alias("n_before"), "n_incoming",
            F.lit(n_new).cast("long").alias("n_new"), F.lit(n_updated).cast("long").alias("n_updated"),
            F.lit(n_before - n_updated).cast("long").alias("n_unchanged"),
            F.lit(n_after).cast("long").alias("n_after"), F.lit(len(changed)).alias("buckets_rewritten"))
