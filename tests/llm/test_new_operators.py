"""Secret scans, conversation repair and centroid clusters: edge cases and brute force."""

import base64
import hashlib
import itertools
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlens.llm import centroid_clusters, conversation_repair, secret_scan

rng = random.Random(11)


# 12. Secrets

def der(tag, content):
    size = len(content)
    length = bytes([size]) if size < 128 else bytes([0x80 + (n := (size.bit_length() + 7) // 8)]) + size.to_bytes(n)
    return bytes([tag]) + length + content


def integer(size):
    return der(2, bytes([rng.randrange(1, 128)]) + rng.randbytes(size - 1))


def keys():
    rsa = der(0x30, b"\x02\x01\x00" + integer(128) + integer(3) + integer(128) + b"".join(integer(64) for _ in range(5)))
    oid = der(6, bytes.fromhex("2a864886f70d010101"))
    pkcs8 = der(0x30, b"\x02\x01\x00" + der(0x30, oid + b"\x05\x00") + der(4, rsa))
    ec = der(0x30, b"\x02\x01\x01" + der(4, rng.randbytes(32)) + der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
    text = lambda b: len(b).to_bytes(4) + b
    ssh = (secret_scan.MAGIC + text(b"none") + text(b"none") + text(b"") + (1).to_bytes(4) + text(rng.randbytes(51))
           + text(rng.randbytes(136)))
    sealed = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, b"")) + der(4, rng.randbytes(64)))
    public = der(0x30, der(0x30, oid + b"\x05\x00") + der(3, b"\x00" + rng.randbytes(140)))
    return {"rsa": rsa, "pkcs8": pkcs8, "ec": ec, "openssh": ssh, "encrypted": sealed}, public


def url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(head, size, body=b'{"sub":"x"}'):
    return f"{url(json.dumps(head).encode())}.{url(body)}.{url(rng.randbytes(size))}"


def wrapped(data, end="\n"):
    text = base64.b64encode(data).decode()
    return end.join(text[i:i + 64] for i in range(0, len(text), 64))


def structural(text):
    return [s for s in secret_scan.spans(text) if s[0] in ("key", "token")]


def test_encoded_keys_are_found_exactly_and_only_whole():
    private, public = keys()
    for kind, data in private.items():
        for end in ("\n", "\r\n", "\\n"):
            body = wrapped(data, end)
            text = f"é -----BEGIN KEY-----{end}{body}{end}-----END KEY-----"
            start = text.index(body)
            assert structural(text) == [("key", start, start + len(body), kind)]
        assert structural("x " + base64.b64encode(data).decode() + "\nNextline of prose")[0][3] == kind
        if kind != "ec":
            assert structural("k=" + data.hex() + ".") == [("key", 2, 2 + 2 * len(data), kind)]
        cut = base64.b64encode(data[:-3]).decode()
        assert structural(cut) == [] and structural(data[:-3].hex()) == [] and structural("0" + data.hex()) == []
        changed = bytearray(data)
        changed[len(secret_scan.MAGIC) + 2 if kind == "openssh" else 4] ^= 0x55
        assert structural(base64.b64encode(bytes(changed)).decode()) == []
    assert structural(base64.b64encode(public).decode()) == []
    assert structural("M" * 5000) == [] and structural("30" * 5000) == [] and structural("ey" * 5000 + ".a.b") == []


def test_signed_tokens_need_a_header_and_a_signature_of_its_length():
    good = token({"alg": "HS256", "typ": "JWT"}, 32)
    assert structural(f"Bearer {good}. Next") == [("token", 7, 7 + len(good), "HS256")]
    assert structural(f"{good}.more.words") == [("token", 0, len(good), "HS256")]
    sealed = f"{url(json.dumps({'alg': 'dir', 'enc': 'A128GCM'}).encode())}..{url(b'i' * 12)}.{url(b'text')}.{url(b't' * 16)}"
    assert structural(sealed) == [("token", 0, len(sealed), "dir")]
    deep = url(b'{"a":' * 90_000)
    for bad in (token({"alg": "HS256"}, 31), token({"typ": "JWT"}, 32), token({"alg": "none"}, 0), token({"alg": 5}, 32),
                good[1:], "x" + good, url(b"[1]") + ".a.b", "eyJ.eyJ.eyJ", "ey.a.b", deep + ".aaaa.bbbb", sealed[:-23]):
        assert structural(bad) == [], bad[:50]


def plain_base(text):
    """The three base patterns, read off one character at a time."""
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    found, i = [], 0
    while i < len(text):
        low = "".join(c.lower() if c.isascii() else c for c in text[i:i + 8])
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w)), None)
        j = i + len(word or "")
        if word:
            j += text[j:j + 1] in ('"', "'") and text[j:j + 1] != ""
            while text[j:j + 1] == " ":
                j += 1
            if text[j:j + 1] in (":", "=") and text[j:j + 1]:
                j += 1
                while text[j:j + 1] == " ":
                    j += 1
                j += text[j:j + 1] in ('"', "'") and text[j:j + 1] != ""
                k = j
                while text[k:k + 1] in value and k < len(text):
                    k += 1
                if k > j:
                    if k - j >= 8:
                        found.append((i, 0, k))
                    i = k
                    continue
        i += 1
    for rank, start, letters, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "", "0123456789abcdef", 32)):
        i = 0
        while i < len(text):
            if not text.startswith(start, i) or text[i] not in letters:
                i += 1
                continue
            k = i + len(start)
            while k < len(text) and text[k] in letters:
                k += 1
            if k - i >= least and k > i + len(start):
                found.append((i, rank, k))
            i = max(k, i + 1)
    return [f"{secret_scan.KINDS[r]}:{a}:{b}" for a, r, b in sorted(found)]


PIECES = ["password", "PassWd", "secret", "ToKen", "api_key", "APIKEY", "paſſword", "toKen", ":", "=", " ", "  ", "\t",
          '"', "'", "abcdefgh", "abc", "AKIA", "AKIAAKIA", "ABCDEFGHIJKL", "0123456789abcdef" * 2, "deadbeef" * 3, "F", ".", "é", "\n",
          "token=secret: abcdefghi", "x.y-z_", "=="]


def test_base_spans_equal_brute_force(spark):
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    texts += ["password=" + "a" * 200_000, "f" * 200_000, "AKIA" * 50_000, "token " * 50_000]
    for text in texts:
        got = [f"{k}:{a}:{b}" for k, a, b, _ in secret_scan.spans(text) if k in secret_scan.KINDS[:3]]
        assert got == plain_base(text), text[:200]


def test_secret_rows(spark, tmp_path):
    private, _ = keys()
    rows = [(1, "token: abcdefghij"), (1, "token: abcdefghij"), (2, None), (3, ""), (None, "AKIA" + "B" * 12),
            (4, "é" + private["rsa"].hex())]
    docs = spark.createDataFrame([(i, t, "k", [1]) for i, t in rows], "doc_id long, text string, kind string, spans array<int>")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = secret_scan.op12_secret_scan(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or -1, r.spans) for r in got) == sorted(
        [(1, "assign:0:17")] * 2 + [(2, ""), (3, ""), (-1, "access:0:16"), (4, f"hex:1:{(n := len(private['rsa'].hex())) + 1},key:1:{n + 1}")])
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].base_sha256 == hashlib.sha256(b"").hexdigest() and by_id[1].n_assign == 1
    assert by_id[4].base_sha256 == hashlib.sha256(f"hex:1:{n + 1}".encode()).hexdigest() and by_id[4].n_hex == 1
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


# 11. Conversations

def brute(rows, most):
    """Cheapest edits by trying all strings of edits up to a length, shortest cost and least string first."""
    found = conversation_repair.faults(rows)
    best = None

    def walk(i, text, cost, audit, inserts):
        nonlocal best
        if best and (cost, audit) > best[:2] and cost > best[0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in text)):
            best = min(best or (cost, audit, text), (cost, audit, text))
        if inserts < most:
            for role in ("user", "assistant"):
                walk(i, text + [(role, "")], cost + 3, audit + "I", inserts + 1)
        if i == len(rows):
            return
        walk(i + 1, text, cost + 4, audit + "D", inserts)
        if found[i] in ("blank", "duplicate"):
            return
        more = 3 if found[i] == "truncated" else 0
        if rows[i][0]:
            walk(i + 1, text + [rows[i]], cost + more, audit + "K", inserts)
        for role in ("user", "assistant"):
            walk(i + 1, text + [(role, rows[i][1])], cost + 3 + more, audit + "R", inserts)

    walk(0, [], 0, "", 0)
    return best


def test_repairs_equal_brute_force():
    roles = ["system", "user", "user", "assistant", "assistant", "tool", " ", ""]
    texts = ["One.", "Two!", "Three?", "cut off", "", " \n", "One. "]
    for _ in range(400):
        rows = [(rng.choice(roles), rng.choice(texts) + rng.choice(["", f"{rng.random()}."])) for _ in range(rng.randrange(0, 5))]
        search = conversation_repair.Search([r[:1] for r, _ in rows], conversation_repair.faults(rows))
        audit, cost = search.run()
        want = brute(rows, 4)
        assert (cost, audit, conversation_repair.apply(rows, audit)) == want, rows


def cheapest_forward(initials, found):
    """Least (cost, edits) per state, row by row."""
    search = conversation_repair.Search(initials, found)
    ways = {0: (0, "")}
    for i in range(len(initials) + 1):
        for _ in range(2):
            for state, (cost, edits) in sorted(ways.items()):
                to = conversation_repair.NEXT[state][conversation_repair.WANTED[state][0]]
                ways[to] = min(ways.get(to, (1 << 60, "")), (cost + 3, edits + "I"))
        if i == len(initials):
            return min(ways[s] for s in (0, 3) if s in ways)
        after = {}
        for state, (cost, edits) in ways.items():
            for edit, c, j, to in search.moves(i, state):
                if j == i + 1:
                    after[to] = min(after.get(to, (1 << 60, "")), (cost + c, edits + edit))
        ways = after


@pytest.mark.parametrize("mix", ["u", "s", "a", "t", "us", "ua", "usat", "uuuuas", "ssssu"])
def test_long_conversations_are_repaired_in_time(mix):
    for n in (3, 50, 1500):
        initials = [rng.choice(mix) for _ in range(n)]
        found = [rng.choice(["", "", "truncated", "blank", "duplicate"]) for _ in range(n)]
        audit, cost = conversation_repair.Search(initials, found).run()
        assert (cost, audit) == cheapest_forward(initials, found)


def test_the_bound_is_never_above_the_cost():
    for _ in range(300):
        n = rng.randrange(0, 9)
        initials = [rng.choice("suat") for _ in range(n)]
        found = [rng.choice(["", "truncated", "blank"]) for _ in range(n)]
        assert conversation_repair.Search(initials, found).least(0, 0) <= cheapest_forward(initials, found)[0]


def test_conversation_rows(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, 7, "user", "Bye"),
            (2, None, None, None), (None, 3, "user", "A."), (None, None, "system", "S."), (3, 1, "user", "x.")]
    df = spark.createDataFrame([(*r, "c", r[0] == 3) for r in rows],
                               "conv_id long, turn long, role string, text string, rows string, gone boolean")
    got = {r.conv_id: r for r in conversation_repair.repair(df, "gone").collect()}
    assert len(got) == 4
    assert (got[1].gaps, got[1].duplicate, got[1].truncated, got[1].illegal) == (4, 1, 1, 1)
    assert (got[1].audit, got[1].cost) == ("KKDD", 8)
    assert got[2].audit == "D" and got[2].blank == 1 and got[2].gaps == 0 and got[2].rows == []
    assert [tuple(r) for r in got[None].rows] == [("system", "S."), ("user", "A."), ("assistant", "")]
    assert got[3].audit == "" and got[3].cost == 0 and got[3].rows == []
    assert conversation_repair.repair(df.limit(0)).count() == 0


def test_damage(spark):
    df = spark.range(2000).select((F.col("id") % 40).alias("conv_id"), F.col("id").alias("turn"), F.lit("system").alias("role"),
                                  F.lit("A. b! c? d").alias("text"))
    got = {}
    for r in conversation_repair.damaged(df).collect():
        got.setdefault(r.turn, []).append(r)
    import zlib

    for turn, rows in got.items():
        number = zlib.crc32(f"{turn % 40}:{turn}".encode()) % 20
        assert len(rows) == (2 if number == 3 else 1) and rows[0].dropped == (number == 0)
        assert rows[0].text == {1: "", 2: "A b c d"}.get(number, "A. b! c? d")
        assert rows[0].role == ("user" if number == 4 else "system")


# 13. Clusters

def plain_clusters(rows, clusters=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows]
    starts = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [v for _, v in starts]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d), v))
        return out

    for _ in range(rounds):
        groups = {}
        for _, k, _, v in assign():
            groups.setdefault(k, []).append(v)
        for k, vs in groups.items():
            centroids[k] = [sum(c) // len(vs) for c in zip(*vs)]
    final = assign()
    sums = [sum(d for _, k, d, _ in final if k == c) for c in range(len(centroids))]
    return sorted(((-1 if i is None else i), k, d, sums[k], sum(sums), tuple(centroids[k])) for i, k, d, _ in final)


@pytest.mark.parametrize("kind", ["random", "copies", "few", "bins"])
def test_clusters_equal_brute_force(spark, kind):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(60, 64)).astype(np.float32)
    if kind == "copies":
        vectors = vectors[draw.integers(0, 3, 60)]
    if kind == "bins":
        vectors = draw.choice([-0.5, 0.25], size=(60, 64)).astype(np.float32)
    rows = [(i if i != 5 else None, v.tolist()) for i, v in enumerate(vectors)]
    rows += rows[:3]
    if kind == "few":
        rows = rows[:5]
    odd = [(90, None), (91, [1.0] * 63), (92, [1.0] * 63 + [None]), (93, [1.0] * 63 + [float("nan")]), (94, [1.0] * 63 + [float("inf")]), (95, [])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, label int, cluster int")
    want = plain_clusters(rows)
    for chunk in (7, 2048):
        got = centroid_clusters.cluster(df.repartition(3), chunk=chunk).collect()
        assert sorted((-1 if r.vec_id is None else r.vec_id, *r[1:5], tuple(r.centroid)) for r in got) == want


def test_dictionaries_lose_nothing():
    draw = np.random.default_rng(8)
    for vectors in (draw.integers(-300, 300, (500, 64)), draw.integers(0, 2, (500, 64)), np.repeat(draw.integers(-9, 9, (5, 64)), 100, 0)):
        chunk = centroid_clusters.Chunk.encode(vectors)
        back = np.concatenate([chunk.entries[low:high][chunk.codes[:, b]]
                               for b, (low, high) in enumerate(itertools.pairwise(chunk.starts))], axis=1)
        assert (back == vectors).all()
        centroids = vectors[:4] + 1
        assert (chunk.distances(centroids) == ((vectors[:, None] - centroids[None]) ** 2).sum(2)).all()
    assert chunk.width == 16 and len(chunk.entries) <= 20


def test_clusters_of_nothing_and_of_too_much(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<float>")
    assert centroid_clusters.cluster(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="134217728"):
        centroid_clusters.cluster(df).count()
