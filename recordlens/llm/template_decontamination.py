"""Documents that hold benchmark passages, also with numbers, names or units exchanged; column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, bounded_broadcast, documents, packed, stage, unpacked

WINDOW = 8               # template tokens per window; shorter items are matched as a whole
LEAST_LITERAL = 4        # windows with fewer ordinary words match by their literal tokens only
LEAST_TOKENS = 13        # matched tokens that make a passage, or the whole of a shorter item
LEAST_SHARE = 0.5        # ... or this share of the item
MOST_CONFLICTS = 0.34    # share of slots that may be filled inconsistently
BROADCAST_WINDOWS = 1_000_000  # benchmark windows that may be broadcast (40 bytes each); beyond, they are shuffled
BROADCAST_KEYS = 1_000_000     # matched documents whose keys may be broadcast
NAME_MARK = "\u0001"
UNITS = ("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs day days week weeks month months year "
         "years hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles "
         "foot feet inch inches gram grams kilogram kilograms pound pounds liter liters litre litres percent dollar "
         "dollars euro euros cent cents usd eur gbp degree degrees mph kmh hz khz mhz ghz kb mb gb tb w kw v a").split()


NAMES = r"([\p{L}\p{N},;:])[\s\p{Z}]+(?=\p{Lu}\p{Ll})"  # what a name inside a sentence stands behind
MEASURES = (r"(\p{N})[\s\p{Z}]*(?=(?i:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}]))")
TOKEN = r"\u0001?\p{L}+|\p{N}+(?:[.,]\p{N}+)*"


def tokens(text: Column) -> Column:
    """Words and numbers of a text in order. A word with a capital inside a sentence and a unit behind a number
    bear a mark in front."""
    marked = F.regexp_replace(F.regexp_replace(text, NAMES, f"$1 {NAME_MARK}"), MEASURES, f"$1 {NAME_MARK}")
    return F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0))


def is_marked(token: Column) -> Column:
    return F.startswith(token, F.lit(NAME_MARK))


def word(token: Column) -> Column:
    return F.lower(F.when(is_marked(token), F.substring(token, 2, 1_000_000_000)).otherwise(token))


def plain(raw: Column) -> Column:
    """Hash per token of its lower-case word, whatever its slot, case and white space."""
    return F.transform(raw, lambda x: F.xxhash64(word(x)))


def template(raw: Column, hashes: Column) -> Column:
    """The hash per token, or a small number for a slot: 1 number, 2 name, 3 unit."""
    first = lambda x: F.substring(x, 1, 1)
    number = lambda x: first(x).between("0", "9") | ((first(x) > "z") & x.rlike(r"^\p{N}"))
    return F.zip_with(raw, hashes, lambda x, h: F.when(
        is_marked(x), F.when(word(x).isin(*UNITS), F.lit(3)).otherwise(F.lit(2)).cast("long")).when(
        number(x), F.lit(1).cast("long")).otherwise(h))


def named(raw: Column, kinds: Column) -> Column:
    """``kinds`` with slots also for words that open a sentence and are marked as names elsewhere in the text.

    A text without such words keeps its array as it is; else only words with a capital are looked up, among the
    names that do open a sentence somewhere.
    """
    capital = r"^\p{Lu}\p{Ll}"
    names = F.transform(F.filter(raw, lambda x: is_marked(x) & F.rlike(x, F.lit(r"^.\p{Lu}\p{Ll}"))),
                        lambda x: F.substring(x, 2, 1_000_000_000))

    def replaced(both: Column) -> Column:
        return F.when(F.size(both) == 0, kinds).otherwise(F.zip_with(raw, kinds, lambda x, k: F.when(
            x.rlike(capital) & F.array_contains(both, x),
            F.when(word(x).isin(*UNITS), F.lit(3)).otherwise(F.lit(2)).cast("long")).otherwise(k)))

    def looked_up(found: Column) -> Column:
        return F.when(F.size(found) == 0, kinds).otherwise(
            bind(F.array_intersect(found, F.filter(raw, lambda x: x.rlike(capital))), replaced))

    return bind(names, looked_up)


def forms(text: Column) -> Column:
    """A text's tokens and three numbers per token: in the template, in the template with names at the start of
    sentences, and the hash of the word without regard to slots, case and white space."""
    def with_template(raw: Column, hashes: Column) -> Column:
        return bind(template(raw, hashes), lambda kinds: F.struct(
            raw.alias("raw"), kinds.alias("kinds"), named(raw, kinds).alias("named"), hashes.alias("plain")))

    return bind(tokens(text), lambda raw: bind(plain(raw), lambda hashes: with_template(raw, hashes)))


def with_words(form: Column) -> Column:
    return bind(form, lambda f: F.struct(F.transform(f["raw"], word).alias("words"), f["kinds"].alias("kinds"),
                                         f["named"].alias("named"), f["plain"].alias("plain")))


def slotted(kinds: Column, width: int) -> Column:
    """Places (from 0) of the windows that hold a slot."""
    last = F.size(kinds) - width
    around = F.transform(kinds, lambda k, i: F.when(k.between(1, 3), F.sequence(
        F.greatest(i - (width - 1), F.lit(0)), F.least(i, F.greatest(last, F.lit(0))))))
    return F.when((last >= 0) & F.exists(kinds, lambda k: k.between(1, 3)),
                  F.array_distinct(F.flatten(F.array_compact(around)))).otherwise(F.array().cast("array<int>"))


def differing(kinds: Column, other: Column, width: int) -> Column:
    """Places of the windows in which the two arrays differ."""
    marks = lambda: F.zip_with(kinds, other, lambda a, b: F.when(a != b, F.lit(1).cast("long")))
    return F.when(kinds == other, F.array().cast("array<int>")).otherwise(slotted(marks(), width))


def window_hashes(form: str, width: int) -> Column:
    """(pos, hash) of a text's windows as plain words, of those with a slot as templates, and of those that names at
    the start of sentences change; empty for a text with fewer tokens.

    A window without a slot is its own template, so it is hashed once.
    """
    def hashed(kinds: str, places: Column) -> Column:
        return F.transform(places, lambda i: F.struct(
            i.alias("pos"), F.xxhash64(F.slice(f"{form}.{kinds}", i + 1, width)).alias("hash")))

    last = F.size(f"{form}.plain") - width
    every = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    kinds, name_kinds = F.col(f"{form}.kinds"), F.col(f"{form}.named")
    return F.concat(hashed("plain", every), hashed("kinds", slotted(kinds, width)),
                    hashed("named", differing(kinds, name_kinds, width)))


def literal(kinds: Column) -> Column:
    return F.size(F.filter(kinds, lambda k: ~k.between(1, 3)))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """item_id, width, item_pos, hash, n_tokens and form per window of each item. Each window has its plain hash;
    those of the templates are left out where they hold too few ordinary words, or none."""
    prepared = stage(items.select("item_id", with_words(forms(F.coalesce("text", F.lit("")))).alias("form")).withColumn(
        "n_tokens", F.size("form.plain")).filter("n_tokens > 0"), "items")
    whole = None
    for width in range(1, WINDOW + 1):
        part = prepared.filter(F.col("n_tokens") >= width if width == WINDOW else F.col("n_tokens") == width)
        least = max(1, min(LEAST_LITERAL, width - 1))

        def hashes(k: str, width: int = width) -> Column:
            every = F.sequence(F.lit(0), F.greatest(F.col("n_tokens") - width, F.lit(0)))
            return F.transform(every, lambda i: F.struct(
                i.alias("pos"), F.xxhash64(F.slice(f"form.{k}", i + 1, width)).alias("hash"),
                literal(F.slice(f"form.{k}", i + 1, width)).alias("literal")))

        told = F.concat(hashes("plain"), *[F.filter(hashes(k), lambda h: h["literal"] >= least) for k in ("kinds", "named")])
        part = part.select("item_id", F.lit(width).alias("width"), "n_tokens", "form", F.explode(told).alias("h"))
        whole = part if whole is None else whole.unionByName(part)
    return whole.select("item_id", "width", "n_tokens", "form", F.col("h.pos").alias("item_pos"),
                        F.col("h.hash").alias("hash")).dropDuplicates(["item_id", "width", "item_pos", "hash"])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, matched_tokens, item_tokens, n_slots, n_conflicts,
    reparameterised.

    Windows of all documents are joined by hash with those of the items: as templates, as templates with names
    at the start of sentences, and as plain words, whatever their case and white space. Matches are put together
    per alignment (document place minus item place), and the longest alignment of each item counts. A slot
    conflicts if the same filler of the item meets different fillers there; too many conflicts clear the
    match. ``reparameterised``: some token differs from the item's.

    NULL texts and ids: a NULL text holds nothing, a NULL doc_id is kept as such. Rows that repeat a doc_id
    are judged each and give one row per item. Items without tokens match nothing, and equal items match alike.
    """
    kept = matches(docs, items)
    best = F.max_by(F.struct("matched_tokens", "item_tokens", "n_slots", "n_conflicts", "reparameterised"),
                    F.struct("matched_tokens", -F.col("n_conflicts")))
    return kept.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def without_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of ``items``.

    A row goes for what its own text holds: rows are told apart by id and text, so neither a NULL nor a repeated id takes
    other rows along. ``docs`` may have any columns besides.
    """
    held = stage(matches(docs, items).select("row").distinct(), "held")
    return unpacked(packed(docs, row=row_key()).join(bounded_broadcast(held), "row", "left_anti"), docs.columns)


def row_key() -> Column:
    """Hash of a row's id and text, by which it is known; it also tells repeated ids apart."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The matches of ``contaminated``, one per alignment, with the ``row`` they lie in."""
    items = stage(benchmark_windows(items), "benchmark-windows")
    n_windows = items.count()
    short = sorted(r.width for r in items.filter(F.col("width") < WINDOW).select("width").distinct().collect())  # at most 7
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), row_key().alias("row"))
    # One pass over the texts for all widths; windows of different widths differ in their hashes.
    form = keyed.select("row", forms(F.col("text")).alias("form"))
    exploded = form.select("row", F.explode(F.concat(*[window_hashes("form", w) for w in (*short, WINDOW)])).alias("h")).select(
        "row", "h.pos", "h.hash")
    wanted = items.select("hash", "width", "item_id", "item_pos", "n_tokens")
    if n_windows <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    found = exploded.join(wanted, "hash").groupBy(
        "row", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "n_tokens"
    ).agg(F.count_distinct("item_pos").alias("n_windows"), F.min("item_pos").alias("low"),
          F.max(F.col("item_pos") + F.col("width")).alias("high"))
    # Windows of one alignment may leave gaps (an exchanged word); what counts is what they cover at least.
    enough = (F.col("n_windows") + F.lit(WINDOW - 1) >= F.least(F.lit(LEAST_TOKENS), F.col("n_tokens"))) | (
        F.col("n_windows") + F.lit(WINDOW - 1) >= F.col("n_tokens") * LEAST_SHARE)
    aligned = stage(found.filter(enough), "alignments")
    rows = aligned.select("row").distinct()
    if rows.count() <= BROADCAST_KEYS:
        rows = F.broadcast(rows)
    # Staged, so that the lambdas below read arrays instead of working them out per element.
    texts = stage(keyed.join(rows, "row", "left_semi").dropDuplicates(["row"]).select(
        "row", "doc_id", with_words(forms(F.col("text"))).alias("doc_form")), "matched-texts")
    fillers = items.select("item_id", "form").distinct()
    checked = aligned.join(texts, "row").join(fillers, "item_id")
    low, high = F.col("low"), F.col("high")

    def at(i: Column) -> Column:
        return F.struct(*[c for k in ("words", "kinds", "named") for c in (
            F.element_at(f"form.{k}", i).alias(k), F.try_element_at(f"doc_form.{k}", i + F.col("shift")).alias(f"doc_{k}"))])

    def same(p: Column, *forms: str) -> Column:
        alike = [p[k].eqNullSafe(p[f"doc_{k}"]) for k in forms]
        return alike[0] if len(alike) == 1 else alike[0] | same(p, *forms[1:])

    def slot(p: Column, k: str) -> Column:
        return p[k].between(1, 3) & same(p, k)

    pairs = checked.withColumn("pairs", F.transform(F.sequence(low + 1, high), at))
    slots = F.array_distinct(F.transform(
        F.filter("pairs", lambda p: slot(p, "kinds") | slot(p, "named")),
        lambda p: F.struct(p["words"].alias("item"), p["doc_words"].alias("doc"))))
    slotted = pairs.withColumn("slots", slots)
    n_fillers = F.size(F.array_distinct(F.transform("slots", lambda s: s["item"])))
    judged = slotted.select(
        "row", "doc_id", "item_id", F.col("n_tokens").alias("item_tokens"),
        F.size(F.filter("pairs", lambda p: same(p, "words", "kinds", "named"))).alias("matched_tokens"),
        n_fillers.alias("n_slots"), (F.size("slots") - n_fillers).alias("n_conflicts"),
        F.exists("pairs", lambda p: ~same(p, "words")).alias("reparameterised"))
    return judged.filter(F.col("n_conflicts") <= F.col("n_slots") * MOST_CONFLICTS)


def op6_template_decontamination(spark, sf_dir):
    """Every document and benchmark item that it holds."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op6_template_decontamination": op6_template_decontamination}
