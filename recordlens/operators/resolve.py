"""Entity resolution between two sources that share no key.

Side A (permits) is matched to side B (facilities). A *block* is a set of entities with equal
key columns. Candidate pairs are never listed block by block:

* "points at exactly one B" needs only the count and the smallest id of B per block;
* shared events are counted by joining on (block, event) after entities of a block with equal
  event sets have been collapsed into one class, so copies cost one entry;
* names that contain each other meet through an equi-join on (block, substring) in big blocks;
* what stays ambiguous is reported as (A, block) rows plus (block, B) rows.

NULL key parts never match anything.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..session import materialise
from .select import asc, dedupe_prefer, desc
from .spread import spread_join


Stage = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Events:
    """Dated observations of both sides; ``on`` names the columns that must agree.

    Give distinct rows: then an entity has at most one row per day and score, however many
    records it has. Copies change no result but travel through the joins.
    """

    a: DataFrame
    b: DataFrame
    on: tuple[str, ...]


@dataclass(frozen=True)
class TierMatches:
    matched: DataFrame     # A id, B id, match_method, confidence, n_shared_events
    unresolved: DataFrame  # A id, tier, block, n_candidates
    members: DataFrame     # tier, block, B id


def block_of(cols: Sequence[str]) -> Column:
    """Key columns as one text, NULL when any part is NULL; separators in values are escaped."""
    parts = []
    for c in cols:
        text = F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        parts += [F.lit("|"), F.replace(text, F.lit("|"), F.lit("\\|"))]
    return F.concat(*parts[1:])


def _blocked(df: DataFrame, ident: str, cols: Sequence[str], *extra: str) -> DataFrame:
    return df.select(ident, block_of(cols).alias("block"), *extra).filter(
        F.col("block").isNotNull()
    )


def _tier_blocks(df: DataFrame, ident: str, tiers: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """One row per entity and tier whose key is complete."""
    blocks = F.array(*[
        F.struct(F.lit(i).alias("_tier"), block_of(cols).alias("block"))
        for i, (_, cols) in enumerate(tiers)
    ])
    return df.select(ident, F.inline(blocks)).filter(F.col("block").isNotNull())


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), parts)


def _event_sets(side: DataFrame, ident: str, events: DataFrame, on: Sequence[str]) -> DataFrame:
    """(block, id, sorted distinct events). A set is bounded by days x scores, not by rows."""
    return (
        side.join(events.select(ident, F.struct(*on).alias("event")), ident)
        .groupBy("block", ident)
        .agg(F.sort_array(F.collect_set("event")).alias("events"))
    )


def _classes(sets: DataFrame, ident: str) -> DataFrame:
    """Entities of one block with equal event sets, as one row."""
    return sets.groupBy("block", "events").agg(
        F.count(F.lit(1)).alias("size"), F.min(ident).alias("low"), F.max(ident).alias("high")
    )


def _rarest(classes: DataFrame, frequency: DataFrame, rep: str, min_shared: int) -> DataFrame:
    """(block, rep, event) with the events of each class, but for its ``min_shared`` - 1 most frequent ones."""
    ranked = Window.partitionBy("block", rep).orderBy("_f", "event")
    return (
        classes.filter(F.size("events") >= min_shared)
        .select("block", F.col("low").alias(rep), F.size("events").alias("_n"), F.explode("events").alias("event"))
        .join(frequency, ["block", "event"])
        .withColumn("_place", F.row_number().over(ranked))
        .filter(F.col("_place") <= F.col("_n") - (min_shared - 1))
        .select("block", rep, "event")
    )


def _shared_by_class(a_classes: DataFrame, b_classes: DataFrame, min_shared: int) -> DataFrame:
    """Class pairs of a block with at least ``min_shared`` common events.

    Such a pair has a common event among the rare ones of both, in the same order of frequency. So only
    those are joined, and an event that a whole block shares brings no pairs. The counts are exact.
    """
    seen = [c.select("block", F.explode("events").alias("event")) for c in (a_classes, b_classes)]
    frequency = _union(seen).groupBy("block", "event").agg(F.count(F.lit(1)).alias("_f"))
    near = _rarest(a_classes, frequency, "a_rep", min_shared).join(
        _rarest(b_classes, frequency, "b_low", min_shared), ["block", "event"]
    ).select("block", "a_rep", "b_low").distinct()
    a = a_classes.select("block", F.col("low").alias("a_rep"), F.col("events").alias("_a"))
    b = b_classes.select(
        "block", F.col("low").alias("b_low"), F.col("high").alias("b_high"),
        F.col("size").alias("b_size"), F.col("events").alias("_b"))
    return (
        near.join(a, ["block", "a_rep"]).join(b, ["block", "b_low"])
        .withColumn("shared", F.size(F.array_intersect("_a", "_b")).cast("long"))
        .filter(F.col("shared") >= min_shared)
        .drop("_a", "_b")
    )


def _to_members(sets: DataFrame, classes: DataFrame, per_class: DataFrame) -> DataFrame:
    """Spread a result keyed by (block, a_rep) over every entity of the class."""
    keyed = classes.select("block", "events", F.col("low").alias("a_rep"))
    results = keyed.join(per_class, ["block", "a_rep"])
    return spread_join(sets, results, ["block", "events"]).drop("events", "a_rep")


def strict_winner(
    a: DataFrame, b: DataFrame, a_id: str, b_id: str, events: Events,
    min_shared: int = V.MIN_SHARED_EVENTS, stage: Stage = materialise,
) -> DataFrame:
    """For each A the B of its block with strictly the most shared events, if there is one.

    ``a`` and ``b`` hold (id, block). Ties are found by summing class sizes per shared count,
    so no window ever sees a whole block.
    """
    a_sets = stage(_event_sets(a, a_id, events.a, events.on))
    a_classes = stage(_classes(a_sets, a_id))
    b_classes = stage(_classes(_event_sets(b, b_id, events.b, events.on), b_id))
    best = (
        _shared_by_class(a_classes, b_classes, min_shared)
        .groupBy("block", "a_rep", "shared")
        .agg(F.sum("b_size").alias("n_at"), F.min("b_low").alias("winner"))
        .groupBy("block", "a_rep")
        .agg(F.max(F.struct("shared", "n_at", "winner")).alias("best"))
        .filter("best.n_at = 1")
        .select("block", "a_rep", F.col("best.winner").alias(b_id),
                F.col("best.shared").cast("int").alias("n_shared_events"))
    )
    return _to_members(a_sets, a_classes, best).select(a_id, "block", b_id, "n_shared_events")


def tier_match(
    a: DataFrame, b: DataFrame, a_id: str, b_id: str,
    tiers: Sequence[tuple[str, Sequence[str]]], events: Events,
    min_shared: int = V.MIN_SHARED_EVENTS, stage: Stage = materialise,
) -> TierMatches:
    """Match on the tightest key that names one B, or one B after counting shared events.

    Ambiguity is judged per A: many As may share one B. B is never used up, so the tiers do
    not depend on each other: every entity carries its block of every tier, all tiers go
    through the same joins at once, and the tightest success of each A is kept. What several
    branches read is written once by ``stage``.
    """
    ka, kb = _tier_blocks(a, a_id, tiers), _tier_blocks(b, b_id, tiers)
    sizes = kb.groupBy("_tier", "block").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.min(b_id).alias("_only")
    )
    hits = stage(spread_join(ka, sizes, ["_tier", "block"]))
    label = F.element_at(F.array(*[F.lit(name) for name, _ in tiers]), F.col("_tier") + 1)

    exact = hits.filter("n_candidates = 1").select(
        a_id, "_tier", F.col("_only").alias(b_id), F.lit(None).cast("int").alias("n_shared_events"),
        F.lit("exact").alias("confidence"), label.alias("match_method"),
    )
    several = hits.filter("n_candidates > 1").select(a_id, "_tier", "block", "n_candidates")
    open_blocks = several.select("_tier", "block").distinct()
    members = stage(spread_join(kb, open_blocks, ["_tier", "block"], "left_semi"))
    # Blocks of different tiers must not meet in the event join.
    apart = F.struct("_tier", "block").alias("block")
    by_events = strict_winner(
        several.select(a_id, apart), members.select(b_id, apart), a_id, b_id, events, min_shared,
        stage,
    ).withColumn("_tier", F.col("block._tier")).select(
        a_id, "_tier", b_id, "n_shared_events", F.lit("resolved_by_events").alias("confidence"),
        F.concat(label, F.lit("+events")).alias("match_method"),
    )
    matched = stage(dedupe_prefer(_union([exact, by_events]), [a_id], ["_tier", b_id]).select(
        a_id, b_id, "match_method", "confidence", "n_shared_events"
    ))
    unresolved = several.join(matched.select(a_id), a_id, "left_anti").select(
        a_id, label.alias("tier"), "block", "n_candidates"
    )
    return TierMatches(matched, unresolved, members.select(label.alias("tier"), "block", b_id))


def shared_counts(
    pairs: DataFrame, a_id: str, b_id: str, events: Events, name: str = "n_shared_events"
) -> DataFrame:
    """Number of common events of given pairs, zero included. Linear in the pairs' events."""
    on = list(events.on)
    ids = pairs.select(a_id, b_id)
    seen = _union([
        spread_join(ids, frame, [ident]).select(a_id, b_id, *on, F.lit(side).alias("_side"))
        for ident, frame, side in ((a_id, events.a, 1), (b_id, events.b, 2))
    ])
    counts = (
        seen.groupBy(a_id, b_id, *on)
        .agg(F.bit_or("_side").alias("_sides"))
        .groupBy(a_id, b_id)
        .agg(F.count_if(F.col("_sides") == 3).cast("int").alias(name))
    )
    return pairs.join(counts, [a_id, b_id], "left").withColumn(name, F.coalesce(name, F.lit(0)))


def _windows(frame: DataFrame, other: DataFrame, name: str, other_name: str, window: str) -> DataFrame:
    """``frame`` without ``name``, once per distinct part of the name that is as long as some other name of the block.

    Only lengths that occur are cut, so a long name costs its length times the number of those lengths.
    """
    lengths = other.groupBy("block").agg(F.collect_set(F.length(other_name)).alias("_lengths"))
    by_length = spread_join(frame, lengths, ["block"]).withColumn("_n", F.explode("_lengths")).filter(
        F.col("_n") <= F.length(name)).withColumn("_parts", F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.length(name) - F.col("_n") + 1), lambda at: F.substr(F.col(name), at, F.col("_n")))))
    return by_length.drop("_lengths", "_n", name).withColumn(window, F.explode("_parts")).drop("_parts")


def _names_that_contain(a: DataFrame, b: DataFrame, b_id: str, min_len: int) -> DataFrame:
    """(block, a_name) with the lowest and highest B whose name contains it or is in it.

    Parts of names are looked up by equality, which grows with the names and not with their product. A name
    that is taken apart is known by its MD5, so that it is not repeated with each part.
    """
    an = a.filter(F.length("a_name") >= min_len).select("block", "a_name", F.md5("a_name").alias("_md5")).distinct()
    bn = (
        b.filter(F.length("b_name") >= min_len)
        .groupBy("block", "b_name")
        .agg(F.min(b_id).alias("low"), F.max(b_id).alias("high"))
    )
    ends = [F.min("low").alias("low"), F.max("high").alias("high")]
    b_inside = (
        _windows(an, bn, "a_name", "b_name", "b_name").join(bn, ["block", "b_name"])
        .groupBy("block", "_md5").agg(*ends).join(an, ["block", "_md5"])
    )
    a_inside = (
        _windows(bn, an, "b_name", "a_name", "a_name")
        .groupBy("block", "a_name").agg(*ends).join(an, ["block", "a_name"])
    )
    found = ["block", "a_name", "low", "high"]
    return _union([b_inside.select(*found), a_inside.select(*found)]).groupBy("block", "a_name").agg(*ends)


def corroborated_match(
    a: DataFrame, b: DataFrame, a_id: str, b_id: str, block_cols: Sequence[str],
    a_name: str, b_name: str, events: Events, min_shared: int = V.MIN_SHARED_EVENTS,
    min_len: int = 1, stage: Stage = materialise,
) -> DataFrame:
    """Same address block, and names that contain each other or enough shared events.

    Accepted when exactly one B qualifies. Uniqueness needs only the smallest and largest
    qualifying B id: one B qualifies when the two are equal. What several branches read is
    written once by ``stage``, and so is what each way found, since the driver keeps the plan
    and the compiled code of all that is run as one.
    """
    ka = stage(_blocked(a, a_id, block_cols, a_name).withColumnRenamed(a_name, "a_name"))
    kb = _blocked(b, b_id, block_cols, b_name).withColumnRenamed(b_name, "b_name")
    kb = stage(spread_join(kb, ka.select("block").distinct(), ["block"], "left_semi"))

    named = stage(_names_that_contain(ka, kb, b_id, min_len))
    by_name = spread_join(ka, named, ["block", "a_name"])

    a_sets = stage(_event_sets(ka.select(a_id, "block"), a_id, events.a, events.on))
    a_classes = stage(_classes(a_sets, a_id))
    b_classes = stage(_classes(_event_sets(kb.select(b_id, "block"), b_id, events.b, events.on), b_id))
    per_class = stage(
        _shared_by_class(a_classes, b_classes, min_shared)
        .groupBy("block", "a_rep")
        .agg(F.min("b_low").alias("low"), F.max("b_high").alias("high"))
    )
    by_events = _to_members(a_sets, a_classes, per_class)

    # The counts read the matches three times: unstaged, the last plan would hold all of the above three times.
    unique = stage(
        _union([by_name.select(a_id, "low", "high"), by_events.select(a_id, "low", "high")])
        .groupBy(a_id)
        .agg(F.min("low").alias(b_id), F.max("high").alias("_high"))
        .filter(F.col(b_id) == F.col("_high"))
        .drop("_high")
    )
    return shared_counts(unique, a_id, b_id, events).select(
        a_id, b_id, F.lit("street+zip+name_corroborated").alias("match_method"),
        F.when(F.col("n_shared_events") >= min_shared, "address+events")
        .otherwise("address+name_containment").alias("confidence"),
        "n_shared_events",
    )


def handoff_merge(
    unresolved: DataFrame, members: DataFrame, a_info: DataFrame, b_info: DataFrame,
    a_id: str, b_id: str, guard: str, label: str, first: str, last: str,
    min_gap: int = V.HANDOFF_MIN_GAP_DAYS, stage: Stage = materialise,
) -> tuple[DataFrame, DataFrame]:
    """Attach an A to the live one of several Bs that follow each other in time.

    ``unresolved`` is (A, block), ``members`` (block, B), both from the loosest tier, whose
    blocks hold the tighter tiers' candidates. ``a_info`` carries ``guard`` and ``label``,
    ``b_info`` the same ``guard`` and the span. Returns matches and old-to-live id merges.

    Spans with a gap of ``min_gap`` days between neighbours cannot number more than the
    block's whole span divided by that gap, plus one. Bigger groups are ruled out by that
    count alone, so the ordered window only ever sees short groups. These groups and the matches,
    which the merges read again, are written once by ``stage``.
    """
    key = ["block", guard]
    spans = members.join(b_info.select(b_id, guard, first, last), b_id).filter(
        F.col(guard).isNotNull()
    )
    feasible = (
        spans.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_lo"), F.max(last).alias("_hi"))
        .filter((F.col("_n") >= 2)
                & ((F.col("_n") - 1) * max(min_gap, 1) <= F.datediff("_hi", "_lo")))
    )
    kept = stage(spread_join(spans, feasible.select(*key), key, "left_semi"))
    previous = F.lag(last).over(Window.partitionBy(*key).orderBy(asc(first), asc(b_id)))
    chains = (
        kept.withColumn("_gap", F.datediff(F.col(first), previous))
        .groupBy(*key)
        .agg(F.min("_gap").alias("gap_days"),
             F.max(F.struct(last, b_id)).getField(b_id).alias("_live"))
        .filter((F.col("gap_days") > 0) & (F.col("gap_days") >= min_gap))
    )
    waiting = unresolved.select(a_id, "block").join(a_info.select(a_id, guard, label), a_id)
    taken = stage(spread_join(waiting, chains, key))
    matches = taken.select(
        a_id, F.col("_live").alias(b_id), F.lit("handoff").alias("match_method"),
        F.lit("retired_permit_handoff").alias("confidence"),
        F.lit(None).cast("int").alias("n_shared_events"),
    )
    used = taken.groupBy(*key, "_live", "gap_days").agg(
        F.min_by(F.col(label), F.col(a_id)).alias("business")
    )
    merges = dedupe_prefer(
        kept.join(used, key).filter(F.col(b_id) != F.col("_live")).select(
            F.col(b_id).alias("old_id"), F.col("_live").alias("new_id"), "business", "gap_days"
        ),
        ["old_id"], [desc("gap_days"), "new_id"],
    )
    return matches, merges


def guard_check(
    matched: DataFrame, a_info: DataFrame, b_info: DataFrame, a_id: str, b_id: str, guard: str
) -> DataFrame:
    """Flag matches whose guard values are both known and differ."""
    known_a = matched.join(a_info.select(a_id, F.col(guard).alias("_ga")), a_id, "left")
    return (
        spread_join(known_a, b_info.select(b_id, F.col(guard).alias("_gb")), [b_id], "left")
        .withColumn("crosses", F.coalesce(F.col("_ga") != F.col("_gb"), F.lit(False)))
        .drop("_ga", "_gb")
    )


def guard_demote(
    checked: DataFrame, merges: DataFrame, a_id: str, b_id: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split guarded matches into kept and demoted, and drop merges that hung on a demoted one."""
    kept = checked.filter(~F.col("crosses")).drop("crosses")
    demoted = checked.filter("crosses").select(a_id, b_id)
    live = kept.select(F.col(b_id).alias("new_id")).distinct()
    return kept, demoted, spread_join(merges, live, ["new_id"], "left_semi")


def unmatched_status(a: DataFrame, matched: DataFrame, a_id: str, b_id: str, first: str,
                     freeze: Column) -> DataFrame:
    """As without a match: new when first seen after ``freeze``, otherwise a failed match.

    Both get a synthetic B id, so that their records are kept.
    """
    left = a.join(matched.select(a_id), a_id, "left_anti")
    return left.withColumns({
        b_id: F.concat(F.lit("P:"), F.col(a_id).cast("string")),
        "status": F.when(F.col(first) > freeze, "new_after_freeze").otherwise("unmatched"),
    })


def review_queue(
    unresolved: DataFrame, demoted: DataFrame, unmatched: DataFrame, stats: DataFrame,
    a_id: str, b_id: str, triage: Column,
) -> DataFrame:
    """Everything a person has to decide, most consequential first.

    An ambiguous A is one row per block in which it is ambiguous, with the number of candidates
    there, so that candidates of a looser key are not lost; the candidates themselves are the block's rows in ``TierMatches.members``. So a block costs
    the sum, not the product, of its two sides. ``triage`` is a flag over the columns of
    ``stats`` (one row per A).
    """
    ambiguous = unresolved.select(a_id, "block", "n_candidates").distinct()
    none = F.lit(None).cast("string")
    rows = _union([
        ambiguous.select(a_id, none.alias(b_id), "block", F.col("n_candidates").cast("long"),
                        F.lit("ambiguous_time_overlap").alias("reason")),
        demoted.select(a_id, F.col(b_id).cast("string"), none.alias("block"),
                       F.lit(1).cast("long").alias("n_candidates"),
                       F.lit("address_conflict").alias("reason")),
        unmatched.filter("status = 'unmatched'").select(
            a_id, none.alias(b_id), none.alias("block"),
            F.lit(0).cast("long").alias("n_candidates"), F.lit("no_key_match").alias("reason")),
    ])
    return (
        rows.join(stats, a_id, "left")
        .withColumn("could_affect_rankings", F.coalesce(triage, F.lit(False)))
        .orderBy(F.desc("could_affect_rankings"), "reason", a_id)
    )


def match_report(crosswalk: DataFrame) -> DataFrame:
    """Rows per status, method and confidence with their share of all rows."""
    # The total of the few counts, so that the rows are read once.
    total = F.sum("n").over(Window.partitionBy())
    return (
        crosswalk.groupBy("status", "match_method", "confidence")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pct", F.bround(F.col("n") * 100 / total, 1))
        .orderBy(F.desc("n"), "status", "match_method", "confidence")
    )
