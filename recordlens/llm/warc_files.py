"""WARC archives in which pages with a payload seen before become revisit records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .binary_files import read_binary, write_binary
from .common import bounded_batches, new_folder

END = b"\r\n\r\n"               # ends a record; the separator of the writer
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 32                      # parts that the rows of one digest are split into
FIXED_DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, five hex digits (20 bits, four symbols) at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to per page.

    Of pages with equal payloads of at least ``least_bytes``, those with the smallest page_id are responses and
    the others revisit it. NULL html is an empty payload. A NULL page_id is never referred to; a group with
    no other id is all responses, and repeated rows of the smallest id are all responses.

    Digests are counted with map-side combine; only those with several rows are joined back. Their rows are
    salted, so a payload that a third of the pages share is spread.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    heads = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    keys = pages.select(F.col("page_id"), payload.alias("p")).select(
        "page_id", F.octet_length("p").alias("n"), base32_sha1(F.col("p")).alias("payload_digest"))
    originals = (
        keys.filter(F.col("n") >= least_bytes).groupBy("payload_digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("original"))
        .filter(F.col("copies") > 1).select(
            "payload_digest", "original", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = heads.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(originals, ["payload_digest", "salt"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("original")).alias("refers_to"))


def record_bytes(date: str = FIXED_DATE) -> Column:
    """A whole record without its final empty lines, with fresh headers. A revisit keeps no payload."""
    crlf = "\r\n"
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(crlf * 2)).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    address = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(f"WARC/1.1{crlf}WARC-Type: "), F.col("record_type"), F.lit(f"{crlf}WARC-Record-ID: "), name("page_id"),
        F.lit(f"{crlf}WARC-Date: {date}{crlf}WARC-Target-URI: "), address,
        F.lit(f"{crlf}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"{crlf}WARC-Profile: {PROFILE}{crlf}WARC-Refers-To: "), name("refers_to")))
        .otherwise(""),
        F.lit(f"{crlf}Content-Type: application/http; msgtype=response{crlf}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(crlf * 2)).cast("binary")
    return F.concat(head, block)


def write_archives(resolved: DataFrame, path: str, date: str = FIXED_DATE) -> None:
    """Gzip-compressed archives in ``path``, one per task."""
    write_binary(resolved.select(record_bytes(date).alias("record")), "record", path, END, "gzip")


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC headers, HTTP headers and payload of each record, read one at a time."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16)

    def headers(source) -> dict[str, str]:
        found = {}
        while (line := source.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            found[name.strip().lower()] = value.strip()
        return found

    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError("not at the start of a record")
        head = headers(stream)
        block = io.BytesIO(stream.read(int(head["content-length"])))
        if stream.read(4) != END:
            raise ValueError("a record is longer than it says")
        block.readline()
        yield head, headers(block), block.read()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, stored_bytes per record.

    Size and digest of a response are those of the payload that was read; a header that says otherwise ends the job with an
    error. A revisit has its original's, from its headers.
    """
    bounded_batches(spark)

    def stored(head: dict[str, str], http: dict[str, str], payload: bytes) -> tuple[int, str]:
        stated = int(http["content-length"]), head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "revisit":
            return stated
        found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != stated:
            raise ValueError(f"{head['warc-record-id']} does not hold the payload that its headers state")
        return found

    def number(name: str | None) -> int | None:
        text = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "stored_bytes"]
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [(number(h["warc-record-id"]), h["warc-target-uri"], *stored(h, http, payload), h["warc-type"],
                         number(h.get("warc-refers-to")), len(payload))
                        for h, http, payload in parse_archive(batch.column(0)[i].as_py())]
                if not rows:
                    continue
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return read_binary(spark, path).select("content").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, stored_bytes long")


def op9_warc_revisits(spark, sf_dir):
    """Every page written to deduplicated archives and read back."""
    path = new_folder(spark, "warc")
    write_archives(resolve_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op9_warc_revisits": op9_warc_revisits}

ORACLE = {"op9_warc_revisits": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, min(page_id) AS original FROM p GROUP BY d HAVING count(*) > 1)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(d, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN original IS NOT NULL AND original IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original IS DISTINCT FROM page_id THEN original END AS refers_to
FROM p LEFT JOIN g USING (d)
"""}
