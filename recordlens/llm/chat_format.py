"""Conversations as one text with a loss mask, from a declarative template; column expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bind

#: Per role: text before, text after, whether the text itself is trained on. Controls begin with < or [.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False),
    "user": ("<s>[INST] ", " [/INST]", False),
    "assistant": (" ", " </s>", True),
}
#: Any other role: text before its escaped name, text behind the name, text after; never trained on.
OTHER = ("<turn ", "<is>", "</turn>")
#: The machine: which roles may follow which state; the state after a turn is its role.
MOVES = {"start": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}
FINAL = {"assistant"}


def escape(text: Column) -> Column:
    """Put a backslash behind every <, [ and backslash: a < or [ without one begins a control, so none occurs in a text."""
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def format_turns(df: DataFrame, template: dict | None = None, moves: dict | None = None) -> DataFrame:
    """One row per turn: conv_id, turn, role, allowed (the machine's verdict), segments.

    ``segments`` is an array of (kind, role, text, loss): the control before, the escaped text, the control
    after. The text of a role marked for training bears the loss, and so nothing else. NULL text is empty;
    a NULL role is formatted like an unknown one with an empty name, and neither is ever allowed.
    """
    template, moves = template or TEMPLATE, moves or MOVES
    role = F.coalesce(F.col("role"), F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # Roles that are unknown lead to no state from which a move is allowed.
    previous = F.lag(role).over(order)
    started = F.row_number().over(order) > 1
    allowed = reduce(lambda a, b: a | b, [
        ((~started if state == "start" else started & (previous == state)) & role.isin(*sorted(roles)))
        for state, roles in moves.items()])

    def pick(i: int, other: Column) -> Column:
        return reduce(lambda rest, item: F.when(role == item[0], F.lit(item[1][i])).otherwise(rest),
                      template.items(), other)

    def segment(kind: str, text: Column, loss: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    return df.select(
        "conv_id", "turn", "role", "text", F.coalesce(allowed, no).alias("allowed"),
        F.array(
            segment("before", pick(0, F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))), no),
            segment("text", escape(F.coalesce(F.col("text"), F.lit(""))), pick(2, no)),
            segment("after", pick(1, F.lit(OTHER[2])), no)).alias("segments"))


def assemble(turns: DataFrame, final: set | None = None) -> DataFrame:
    """One row per conversation: conv_id, valid, formatted (the whole text), segments (in order).

    Turns come in order of turn, then role, then text (NULL first). A conversation is one row, so its turns
    are gathered; that is bounded by the longest conversation. ``valid``: every move was allowed and the
    last role is a final one. Rows with a NULL conv_id form one conversation.
    """
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "allowed", "segments"))).alias("t"))
    last_role = F.coalesce(F.element_at("t", -1)["role"], F.lit(""))
    segments = F.flatten(F.transform("t", lambda t: t["segments"]))
    return gathered.select(
        "conv_id", (F.forall("t", lambda t: t["allowed"]) & last_role.isin(*sorted(final or FINAL))).alias("valid"),
        segments.alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def format_conversations(df: DataFrame) -> DataFrame:
    return assemble(format_turns(df))


def turns_of(formatted: Column, template: dict | None = None) -> Column:
    """Array of (role, text, loss) read from a formatted text alone; anything else in it ends the job with an error.

    A turn runs from the control before its text to the first control that ends one: no escaped text can hold that, as
    each has a < or [ without a backslash behind it. A template's controls before must differ from each other.
    """
    template = template or TEMPLATE
    quoted = lambda parts: "|".join(f"\\Q{p}\\E" for p in parts)
    before = [b for b, _, _ in template.values()]
    turn = (rf"(?s)(?:{quoted(before)}|\Q{OTHER[0]}\E.*?\Q{OTHER[1]}\E).*?"
            rf"(?:{quoted(a for _, a, _ in template.values())}|\Q{OTHER[2]}\E)")

    def between(x: Column, start: int | Column, after: str) -> Column:
        return F.substring(x, F.lit(start) + 1 if isinstance(start, int) else start + 1,
                           F.char_length(x) - start - len(after))

    def read(x: Column) -> Column:
        named = F.instr(x, OTHER[1]) - 1
        result = F.struct(unescape(F.substring(x, F.lit(len(OTHER[0]) + 1), named - len(OTHER[0]))).alias("role"),
                          unescape(between(x, named + len(OTHER[1]), OTHER[2])).alias("text"), F.lit(False).alias("loss"))
        for role, (start, after, loss) in template.items():
            result = F.when(F.startswith(x, F.lit(start)), F.struct(
                F.lit(role).alias("role"), unescape(between(x, len(start), after)).alias("text"),
                F.lit(loss).alias("loss"))).otherwise(result)
        return result

    def checked(found: Column) -> Column:
        whole = F.aggregate(found, F.lit(0), lambda n, x: n + F.char_length(x)) == F.char_length(formatted)
        return F.when(whole, F.transform(found, read)).otherwise(F.raise_error(
            F.lit("a formatted conversation is not made of turns")).cast("array<struct<role:string,text:string,loss:boolean>>"))

    return bind(F.regexp_extract_all(formatted, F.lit(turn), F.lit(0)), checked)


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted text of each conversation says."""
    turns = formatted.select("conv_id", "formatted", "valid", turns_of(F.col("formatted")).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


def op10_chat_format(spark, sf_dir):
    """All conversations and one whose texts hold control strings, formatted and read back."""
    tricky = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
        "AS t(conv_id, turn, role, text)")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(tricky)))


QUERIES = {"op10_chat_format": op10_chat_format}

#: Lengths of the controls around a text, per role, and the machine, written out for DuckDB.
ORACLE = {"op10_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body,
    lag(coalesce(role, '')) OVER w AS previous, row_number() OVER w AS k, row_number() OVER b AS back
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST),
    b AS (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC NULLS LAST, text DESC NULLS LAST)),
judged AS (
  SELECT *, CASE WHEN k = 1 THEN role IN ('system', 'user') WHEN previous IN ('system', 'assistant') THEN role = 'user'
      WHEN previous = 'user' THEN role = 'assistant' ELSE false END AS allowed,
    length(body) + length(body) - length(replace(replace(replace(body, '<', ''), '[', ''), '\', ''))
    + CASE role WHEN 'system' THEN length('<<SYS>>' || '<</SYS>>') + 4 WHEN 'user' THEN length('<s>[INST] ' || ' [/INST]')
      WHEN 'assistant' THEN length('  </s>') ELSE length('<turn <is></turn>') + 2 * length(role)
        - length(replace(replace(replace(role, '<', ''), '[', ''), '\', '')) END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(body)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(body, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(allowed) AND bool_or(back = 1 AND role = 'assistant') AS valid
FROM judged GROUP BY conv_id
"""}
