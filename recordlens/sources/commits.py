"""Numbered commits in a shared folder: each number is taken once, by whoever names it first.

A commit is a small JSON file that is written under a name of its own and then renamed to its number without
overwriting. The rename decides a race where the file system's is atomic, as on HDFS; a store without atomic renames
needs one writer at a time.
"""

import json
import uuid

from pyspark.sql import SparkSession


class LostRace(RuntimeError):
    """Another writer has taken the version; nothing of ours is published."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Published versions, in order; none if the folder does not exist."""
    _, where, fs = _hadoop(spark, folder)
    if not fs.exists(where):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def latest(spark: SparkSession, folder: str) -> int:
    """The newest version, 0 before the first."""
    return max(versions(spark, folder), default=0)


def read(spark: SparkSession, folder: str, version: int) -> dict:
    jvm, where, fs = _hadoop(spark, f"{folder}/{version:020d}.json")
    stream = fs.open(where)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    """Take ``version`` for ``content``; raises ``LostRace`` if it is taken."""
    jvm, own, fs = _hadoop(spark, f"{folder}/_{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{version:020d}.json")
    out = fs.create(own, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(own).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(own), fs.makeQualified(target), options)
    except Exception as error:
        fs.delete(own, False)
        if fs.exists(target):
            raise LostRace(f"version {version} of {folder} is taken") from error
        raise
