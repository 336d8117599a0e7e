"""Conversations whose turns are lost, empty, repeated, cut off or of the wrong role, repaired by the cheapest edits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_CHARS, bounded_batches, sorted_by

#: Costs of the edits, white space, marks that end a sentence, pairs of roles that may follow each other.
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED = 3                # added for a truncated row that stays
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
PAIRS = ("su", "ua", "au")
#: The machine over initials. States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("user", "user", "assistant", "user")
ACCEPTING = (0, 3)


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each (role, text): blank, duplicate, truncated or an empty string."""
    seen, found = set(), []
    for role, text in rows:
        core = text.rstrip(BLANKS)
        found.append("blank" if not core else "duplicate" if (role, text) in seen
                     else "truncated" if core[-1] not in ENDS else "")
        seen.add((role, text))
    return found


class Search:
    """Iterative-deepening A* over (rows done, state), with edits tried in ASCII order.

    The bound below: rows that must go or stay truncated cost what they cost; rows whose role fits nowhere need an
    edit each; of neighbours that may not follow each other, disjoint pairs need an edit each (the dearest matching).
    A state whose search failed keeps the least cost that failed as its bound, in this round and in all later ones, so
    no state is searched again before the bound has grown past that.
    """

    def __init__(self, initials: list[str], found: list[str]) -> None:
        self.initials = initials
        self.gone = [f in ("blank", "duplicate") for f in found]
        self.more = [TRUNCATED if f == "truncated" else 0 for f in found]
        self.failed: dict[tuple[int, int], int] = {}
        n = len(initials)
        # An edit of a row costs at least this more than keeping it.
        self.edit = [min(COST["R"], COST["D"] - m) for m in self.more]
        self.needed = [0] * (n + 1)   # cost of the rows from i on that no neighbour changes
        self.systems = [0] * (n + 1)  # dearest edit among the system rows from i on: one of them may be kept
        self.first = [n] * (n + 1)    # first row from i on that may stay
        self.pairs = [0] * (n + 2)    # dearest matching of broken pairs from the row on
        after = n
        for i in range(n - 1, -1, -1):
            odd = initials[i] not in ("u", "a")
            if self.gone[i]:
                self.needed[i], self.systems[i] = self.needed[i + 1] + COST["D"], self.systems[i + 1]
                self.first[i] = after
                continue
            self.needed[i] = self.needed[i + 1] + self.more[i] + (self.edit[i] if odd else 0)
            self.systems[i] = max(self.systems[i + 1], self.edit[i] if initials[i] == "s" else 0)
            self.first[i] = i
            beyond = self.first[after + 1] if after < n else n
            self.pairs[i] = max(self.pairs[after], self.broken(i, after) + (self.pairs[beyond] if after < n else 0))
            after = i

    def broken(self, i: int, j: int) -> int:
        """Least cost of mending the pair of rows i and j (the end, if there is no j); 0 if it holds."""
        a = self.initials[i]
        if a not in ("u", "a"):
            return 0
        if j == len(self.initials):
            return self.edit[i] if a == "u" else 0
        b = self.initials[j]
        return min(self.edit[i], self.edit[j]) if b in ("u", "a") and a == b else 0

    def least(self, i: int, state: int) -> int:
        """A bound below the cost of what is left."""
        n, j = len(self.initials), self.first[i]
        if j == n:
            bound = self.needed[i] + (0, 2 * COST["I"], COST["I"], 0)[state]
        else:
            letter = self.initials[j]
            start = self.edit[j] if letter in ("u", "a") and letter not in NEXT[state] else 0
            bound = self.needed[i] + max(self.pairs[j], start + self.pairs[self.first[j + 1]])
            if state == 0:
                bound -= self.systems[i]
        return max(bound, self.failed.get((i, state), 0))

    def moves(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Edit, its cost and where it leads, in ASCII order of the edits."""
        wanted = NEXT[state][WANTED[state][0]]
        row = i < len(self.initials)
        if row:
            yield "D", COST["D"], i + 1, state
        yield "I", COST["I"], i, wanted
        if row and not self.gone[i]:
            if (to := NEXT[state].get(self.initials[i])) is not None:
                yield "K", COST["K"] + self.more[i], i + 1, to
            yield "R", COST["R"] + self.more[i], i + 1, wanted

    def within(self, bound: int) -> tuple[str | None, int]:
        """The first accepting path that costs at most ``bound``; without one, the least cost found beyond it."""
        end = len(self.initials)
        path: list[str] = []
        frames: list[list] = [[0, 0, 0, 0, self.moves(0, 0), math.inf]]  # row, state, spent, last cost, moves, least
        while frames:
            frame = frames[-1]
            i, state, spent = frame[:3]
            for edit, cost, j, to in frame[4]:
                rest = cost + self.least(j, to)
                if spent + rest > bound:
                    frame[5] = min(frame[5], rest)
                    continue
                path.append(edit)
                if j == end and to in ACCEPTING:
                    return "".join(path), spent + cost
                frames.append([j, to, spent + cost, cost, self.moves(j, to), math.inf])
                break
            else:
                frames.pop()
                self.failed[i, state] = max(self.failed.get((i, state), 0), frame[5])
                if not frames:
                    return None, frame[5]
                path.pop()
                frames[-1][5] = min(frames[-1][5], frame[3] + self.least(i, state))
        raise AssertionError("unreachable")

    def run(self) -> tuple[str, int]:
        """Edits, in order, and their cost."""
        if not self.initials:
            return "", 0
        bound = self.least(0, 0)
        while True:
            path, cost = self.within(bound)
            if path is not None:
                return path, cost
            bound = cost


def apply(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired rows."""
    result, i, state = [], 0, 0
    for edit in audit:
        if edit == "I":
            result.append((WANTED[state], ""))
        elif edit != "D":
            result.append((WANTED[state] if edit == "R" else rows[i][0], rows[i][1]))
        i += edit != "I"
        if edit != "D":
            state = NEXT[state][result[-1][0][0]]
    return result


def repaired(turns: list[int | None], rows: list[tuple[str, str]]) -> dict:
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    audit, cost = Search(initials, found).run()
    known = [t for t in turns if t is not None]
    return {"gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
            **{kind: found.count(kind) for kind in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in PAIRS for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "rows": [{"role": role, "text": text} for role, text in apply(rows, audit)]}


RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "rows array<struct<role: string, text: string>>")
ARROW_RESULT = [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    ("audit", pa.string()), ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]


def repair(df: DataFrame, absent: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, rows (repaired).

    Rows come by turn (NULL first), then role, then text. Each is kept, given a role, or deleted, and empty ones are
    inserted, at the least cost that leads to an optional system row and user and assistant rows in turn; of
    equally cheap ways that whose edits' initials are least in ASCII is taken.

    NULL roles and texts count as one space. A row with another role, or an empty one, cannot be kept as it is. Rows
    with a NULL conv_id form one conversation. Rows for which ``absent`` holds name a conversation but are not part of
    it; one without any row has zeros, no edits and no rows. Other columns are not read. A task holds one
    conversation at a time, as its repair depends on all of it.
    """
    bounded_batches(df.sparkSession)
    conv_type = df.schema["conv_id"].dataType
    rows = df.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
                     (F.col(absent) if absent else F.lit(False)).alias("absent"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, held, known = None, [], [], False
        done: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            arrays = [pa.array([c for c, _ in done], kind)]
            arrays += [pa.array([r[name] for _, r in done], k) for name, k in ARROW_RESULT]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *(name for name, _ in ARROW_RESULT)])

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if known and row[0] != conv:
                    done.append((conv, repaired(turns, held)))
                    if size > SLICE_CHARS or len(done) >= 1000:
                        yield flush()
                        size = 0
                    turns, held = [], []
                conv, known = row[0], True
                if not row[4]:
                    turns.append(row[1])
                    held.append((row[2], row[3]))
                    size += len(row[3])
        if known:
            done.append((conv, repaired(turns, held)))
            yield flush()

    return sorted_by(rows, "conv_id", "turn", "role", "text").mapInArrow(
        run, f"conv_id {conv_type.simpleString()}, {RESULT}")


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows damaged by a hash of conversation and turn.

    0 marks a row as dropped, 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    number = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                              F.coalesce(F.col("turn").cast("string"), blank))) % 20
    text = F.coalesce("text", blank)
    return df.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"), number.alias("number")).select(
        "conv_id", "turn", F.when(F.col("number") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("number") == 1, "").when(F.col("number") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("number") == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("number") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_conversation_repair(spark, sf_dir):
    """All conversations damaged and repaired."""
    repaired_rows = repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "dropped")
    lines = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    return repaired_rows.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(lines, 256).alias("repaired_sha256"))


QUERIES = {"op11_conversation_repair": op11_conversation_repair}

#: A cheapest path per row, state and number of inserts, forward from the first row; crc32 bit by bit.
ORACLE = {"op11_conversation_repair": r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
numbered AS (
  SELECT *, xor(4294967295, list_reduce(
      list_transform(range(length(name) + 1), lambda i: CASE i WHEN 0 THEN 4294967295 ELSE ascii(name[i]) END::BIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, e: xor(d >> 1, (d & 1) * 3988292384)))) % 20 AS number
  FROM source),
hurt AS (
  SELECT conv_id, turn, CASE number WHEN 4 THEN 'user' ELSE role END AS role,
    CASE number WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE number WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM numbered),
placed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, role, text,
    row_number() OVER w AS i, lag(role[1]) OVER w AS before, lag(i0) OVER w AS earlier
  FROM (SELECT *, 1 AS i0 FROM hurt) WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
facts AS (
  SELECT g, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY g),
grid AS (
  SELECT * FROM (VALUES (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')) t(state, letter, next, wanted)),
inserts AS (
  SELECT state AS a, state AS z, 0 AS cost, '' AS edits, '' AS lines FROM grid
  UNION ALL SELECT state, next, 3, 'I', wanted || ':' || chr(10) FROM grid
  UNION ALL SELECT x.state, y.next, 6, 'II', x.wanted || ':' || chr(10) || y.wanted || ':' || chr(10)
    FROM grid x JOIN grid y ON y.state = x.next),
steps AS (
  SELECT g, i, a, state AS z, s.cost + CASE edit WHEN 'D' THEN 4 ELSE
      CASE edit WHEN 'R' THEN 3 ELSE 0 END + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END END AS cost,
    s.edits || edit AS edits, s.lines || CASE edit WHEN 'D' THEN '' WHEN 'R' THEN wanted || ':' || text || chr(10)
      ELSE role || ':' || text || chr(10) END AS lines, next
  FROM judged CROSS JOIN inserts s JOIN (
    SELECT state, 'D' AS edit, NULL AS letter, state AS next, wanted FROM grid
    UNION ALL SELECT state, 'K', letter, next, wanted FROM grid UNION ALL SELECT 0, 'K', 's', 1, NULL
    UNION ALL SELECT state, 'R', NULL, next, wanted FROM grid) m ON m.state = s.z
  WHERE edit = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR letter = role[1]))),
best AS (
  SELECT g, 0::BIGINT AS i, 0 AS state, {'cost': 0, 'edits': '', 'lines': ''} AS way FROM facts
  UNION ALL
  SELECT b.g, s.i, s.next, min({'cost': b.way.cost + s.cost, 'edits': b.way.edits || s.edits, 'lines': b.way.lines || s.lines})
  FROM best b JOIN steps s ON s.g = b.g AND s.i = b.i + 1 AND s.a = b.state GROUP BY b.g, s.i, s.next),
ended AS (
  SELECT b.g, min({'cost': b.way.cost + s.cost, 'edits': b.way.edits || s.edits, 'lines': b.way.lines || s.lines}) AS way
  FROM best b JOIN facts f ON f.g = b.g AND f.n = b.i JOIN inserts s ON s.a = b.state AND s.z IN (0, 3) GROUP BY b.g)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
  coalesce(way.edits, '') AS audit, sha256(coalesce(way.lines[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN (SELECT DISTINCT g, conv_id FROM judged) k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN facts ON facts.g = k.g LEFT JOIN ended ON ended.g = k.g
"""}
