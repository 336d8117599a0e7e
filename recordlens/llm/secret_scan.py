"""Secrets in texts: assignments, access ids, long hex runs, and encoded keys and signed tokens whose structure holds."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, documents, text_slices

#: Kinds in the order of equal starts, the patterns of the first three and their least lengths.
KINDS = ("assign", "access", "hex", "key", "token")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
LEAST_ASSIGNED = 8           # a shorter value is dropped, with all that its match took
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # a run of 16 or more: a shorter one holds no other start that could reach it
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Candidates: base64 and hex runs that begin like an ASN.1 sequence or an OpenSSH key, three or five dotted parts
#: of which the first begins like an object. Line breaks inside base64 may be real or escaped.
MAGIC = b"openssh-key-v1\0"
BREAK = r"(?:\r?\n|\\r\\n|\\n)[ \t]*"
ESCAPED = r"(?<=\\[nrt])"  # behind an escaped line break a candidate may begin, though its last character is a letter
BASE64_KEY = re.compile(
    rf"(?:(?<![A-Za-z0-9+/])|{ESCAPED})(?:M[A-Za-z0-9+/]{{7}}|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/]*(?:{BREAK}[A-Za-z0-9+/]+)*={{0,2}}")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[fF]70656[eE]7373682[dD]6[bB]65792[dD]763100)[0-9A-Fa-f]{30,}")
LETTER = "[A-Za-z0-9_-]"
DOTTED = re.compile(rf"(?:(?<![A-Za-z0-9_.-])|{ESCAPED})e[wy]{LETTER}+(?:\.{LETTER}*(?:\.{LETTER}+){{3}}|(?:\.{LETTER}+){{2}})")
#: Bytes of a signature per algorithm; those of RSA are as long as the key, 128 bytes or more.
SIGNATURES = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,),
              "ES512": (132,), "EdDSA": (64, 114)}
RSA_SIGNED = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
#: Object identifiers (encoded) under which encrypted keys begin: password-based schemes.
PASSWORD_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
INTEGER, OCTETS, OBJECT, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def header(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the element at ``at``, by its stated length; None if there is none."""
    if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
        return None
    size, start = data[at + 1], at + 2
    if size > 0x7F:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > len(data):
            return None
        size, start = int.from_bytes(data[start:start + n]), start + n
        if size < 0x80 or size >> 8 * (n - 1) == 0:
            return None  # not the shortest way to state it
    return data[at], start, start + size


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the elements that fill ``data`` exactly; None if their lengths do not."""
    found, at = [], 0
    while at < len(data):
        item = header(data, at)
        if item is None or item[2] > len(data):
            return None
        found.append((item[0], data[item[1]:item[2]]))
        at = item[2]
    return found


def sequence_kind(data: bytes) -> str | None:
    """Kind of private key that a whole ASN.1 sequence holds; None for anything else, public keys included."""
    outer = elements(data)
    inner = elements(outer[0][1]) if outer and len(outer) == 1 and outer[0][0] == SEQUENCE else None
    if not inner:
        return None
    tags, parts = [t for t, _ in inner], [c for _, c in inner]
    if tags == [SEQUENCE, OCTETS]:
        scheme = elements(parts[0])
        named = scheme and scheme[0][0] == OBJECT and scheme[0][1].startswith(PASSWORD_SCHEMES)
        return "encrypted" if named and len(parts[1]) >= 16 else None
    if tags[0] != INTEGER or len(parts[0]) != 1:
        return None
    version = parts[0][0]
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and version <= 1:
        algorithm = elements(parts[1])
        return "pkcs8" if algorithm and algorithm[0][0] == OBJECT and elements(parts[2]) else None
    if tags[:2] == [INTEGER, OCTETS] and version == 1 and len(parts[1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return "ec"
    if set(tags[:9]) == {INTEGER} and version <= 1 and all(parts):
        if len(tags) >= 9 and len(parts[1]) >= 32:
            return "rsa"
        if len(tags) == 6 and len(parts[1]) >= 32:
            return "dsa"
    return None


def openssh_size(data: bytes) -> int | None:
    """Bytes of an OpenSSH key by its nested lengths: three strings, a count, as many public keys, the private part."""
    at = len(MAGIC)

    def string(at: int) -> int | None:
        end = at + 4 + int.from_bytes(data[at:at + 4]) if at + 4 <= len(data) else len(data) + 1
        return end if end <= len(data) else None

    for _ in range(3):
        if (at := string(at)) is None:
            return None
    count, at = int.from_bytes(data[at:at + 4]), at + 4
    if not 1 <= count <= 16:
        return None
    for _ in range(count + 1):
        if (at := string(at)) is None:
            return None
    return at


def key(data: bytes) -> tuple[str, int] | None:
    """Kind and exact size of the private key that ``data`` begins with."""
    if data.startswith(MAGIC):
        size = openssh_size(data)
        return ("openssh", size) if size else None
    item = header(data, 0)
    if item is None or item[2] > len(data):
        return None
    kind = sequence_kind(data[:item[2]])
    return (kind, item[2]) if kind else None


def base64_key(text: str) -> tuple[str, int] | None:
    """Kind and length in ``text`` of the encoded key it begins with; nothing but a line break or the end may follow."""
    lines = [(m.start(), m.group()) for m in re.finditer(r"[A-Za-z0-9+/]+", re.sub(r"\\[rn]", "\n\n", text))]
    whole = "".join(part for _, part in lines)
    whole = whole[:len(whole) - (len(whole) % 4 == 1)]
    found = key(base64.b64decode(whole + "=" * (-len(whole) % 4)))
    if not found:
        return None
    chars = (found[1] * 4 + 2) // 3
    for at, part in lines:
        if chars <= len(part):
            if chars < len(part):
                return None
            end = at + chars
            while text[end:end + 1] == "=":
                end += 1
            return found[0], end
        chars -= len(part)
    return None


def hex_key(text: str) -> tuple[str, int] | None:
    found = key(binascii.unhexlify(text[:len(text) // 2 * 2]))
    return (found[0], len(text)) if found and found[1] * 2 == len(text) else None


def part(text: str) -> bytes | None:
    """A part of a token; None if it is not base64 for URLs."""
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), b"-_", validate=True)
    except ValueError:
        return None


def signed_token(text: str) -> tuple[str, int] | None:
    """Algorithm and length of a token: the first part is an object that names it, and the other parts have its form."""
    parts = text.split(".")
    try:
        head = json.loads(part(parts[0]) or b"")
    except (ValueError, RecursionError):
        return None
    name = head.get("alg") if isinstance(head, dict) else None
    if not isinstance(name, str):
        return None
    sealed = isinstance(head.get("enc"), str)
    parts = parts[:5 if sealed else 3]
    decoded = [part(p) for p in parts]
    if None in decoded:
        return None
    size = len(decoded[-1])
    if sealed:
        fits = len(parts) == 5
    else:
        fits = size in SIGNATURES.get(name, ()) or (name in RSA_SIGNED and size >= 128)
    return (name, len(".".join(parts))) if fits else None


def spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, detail) of all secrets of a text, by start and kind; offsets count code points."""
    found = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        found += [("assign", *m.span(), m.group(1).lower()) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= LEAST_ASSIGNED]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [(kind, *m.span(), "") for m in pattern.finditer(text)]
    for kind, pattern, read in (("key", BASE64_KEY, base64_key), ("key", HEX_KEY, hex_key), ("token", DOTTED, signed_token)):
        found += [(kind, m.start(), m.start() + hit[1], hit[0]) for m in pattern.finditer(text) if (hit := read(m.group()))]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = "array<struct<kind: string, start: int, end: int, detail: string>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("detail", pa.string())]))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and spans of each row: an array of (kind, start, end, detail), empty where nothing was found.

    ``assign``, ``access`` and ``hex`` are found by their form. ``key`` and ``token`` are decoded and reported only if
    their structure holds: nested lengths that fill the encoded key exactly and the fields of a private key; a token
    header that names its algorithm, with a signature of that algorithm's length. Public keys, certificates and
    unsigned tokens are not secrets. ``detail``: the word assigned to, the kind of key, or the algorithm.

    NULL text is empty. Rows that repeat a doc_id or a text are judged each; other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found = [[dict(zip(("kind", "start", "end", "detail"), s)) for s in spans(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, ARROW_SPANS)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


def of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op12_secret_scan(spark, sf_dir):
    """Every document with its secrets."""
    base = KINDS[:3]
    counts = [F.size(of_kinds(k)).cast("long").alias(f"n_{k}") for k in base]
    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id", *counts, F.sha2(joined(of_kinds(*base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {"op12_secret_scan": op12_secret_scan}
