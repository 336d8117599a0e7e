"""Data-quality suite: every check yields one (label, ok, n_bad) row, and a detail that names rows which fail."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squish
from ..session import materialise
from .aggregate import duplicates
from .compare import differences


@dataclass(frozen=True)
class RowChecks:
    """Conditions every row of one frame must meet; NULL counts as a failure.

    All conditions of a frame are counted in a single pass over it. ``key`` names a row in details; by default all columns do.
    """

    df: DataFrame
    holds: dict[str, Column]
    key: tuple[str, ...] = ()


@dataclass(frozen=True)
class EmptyCheck:
    """A frame that must have no rows (duplicates, lost keys, differences)."""

    label: str
    df: DataFrame
    key: tuple[str, ...] = ()


@dataclass(frozen=True)
class ValueCheck:
    """A single-row frame whose boolean ``ok`` must be true."""

    label: str
    df: DataFrame
    ok: Column


def _row_results(checks: RowChecks) -> DataFrame:
    labels = list(checks.holds)
    bad = [F.count_if(~F.coalesce(checks.holds[label], F.lit(False))).alias(f"c{i}")
           for i, label in enumerate(labels)]
    rows = F.array(*[F.struct(F.lit(label).alias("label"), F.col(f"c{i}").alias("n_bad"))
                     for i, label in enumerate(labels)])
    return checks.df.agg(*bad).select(F.inline(rows))


def run_checks(checks: Sequence[RowChecks | EmptyCheck | ValueCheck]) -> DataFrame:
    parts = []
    for check in checks:
        if isinstance(check, RowChecks):
            parts.append(_row_results(check))
        elif isinstance(check, EmptyCheck):
            parts.append(check.df.agg(F.count(F.lit(1)).alias("n_bad")).select(
                F.lit(check.label).alias("label"), "n_bad"))
        else:
            passed = F.coalesce(check.ok, F.lit(False))
            parts.append(check.df.select(
                F.lit(check.label).alias("label"),
                F.when(passed, 0).otherwise(1).cast("long").alias("n_bad")))
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.select("label", (F.col("n_bad") == 0).alias("ok"), "n_bad")


def _named(df: DataFrame, key: Sequence[str]) -> Column:
    return F.array_join(F.array(*[F.col(f"`{c}`").cast("string") for c in (key or df.columns)]), "|", "NULL")


def _failures(check: "RowChecks | EmptyCheck | ValueCheck") -> DataFrame:
    """label and witness of everything that fails the check, in one pass over its frame."""
    if isinstance(check, RowChecks):
        failed = F.array_compact(F.array(*[
            F.when(~F.coalesce(holds, F.lit(False)), F.lit(label)) for label, holds in check.holds.items()]))
        return check.df.select(F.explode(failed).alias("label"), _named(check.df, check.key).alias("witness"))
    if isinstance(check, EmptyCheck):
        return check.df.select(F.lit(check.label).alias("label"), _named(check.df, check.key).alias("witness"))
    return check.df.filter(~F.coalesce(check.ok, F.lit(False))).select(
        F.lit(check.label).alias("label"),
        F.array_join(F.array(*[F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")) for c in check.df.columns]), " ", "NULL")
        .alias("witness"))


def run_detailed(checks: Sequence["RowChecks | EmptyCheck | ValueCheck"], witnesses: int = 3) -> DataFrame:
    """label, ok, n_bad and detail: the smallest ``witnesses`` names of failing rows, in order, NULL where nothing fails.

    Each frame is read once; what fails is staged, and then counted and named. Each task keeps its own smallest few
    of a check before they are merged, so the detail is small and does not depend on how rows are dealt. A value check
    shows its values.
    """
    failed = materialise(reduce(lambda a, b: a.unionByName(b), [_failures(c) for c in checks]))
    counts = failed.groupBy("label").agg(F.count(F.lit(1)).alias("n_bad"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("witness"))
    few = failed.distinct().withColumn("_place", place).filter(F.col("_place") <= witnesses)
    named = few.groupBy("label").agg(F.array_join(F.sort_array(F.collect_list("witness")), "; ").alias("detail"))
    labels = [label for c in checks for label in (c.holds if isinstance(c, RowChecks) else [c.label])]
    all_labels = failed.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    return all_labels.join(counts, "label", "left").join(named, "label", "left").select(
        "label", F.col("n_bad").isNull().alias("ok"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"), "detail")


def verdict(results: DataFrame) -> DataFrame:
    """One row: checks run, passed and failed. Publication is gated on ``ok``."""
    return results.agg(
        F.count(F.lit(1)).alias("n_run"),
        F.count_if("ok").alias("n_passed"),
        F.count_if(~F.col("ok")).alias("n_failed"),
    ).withColumn("ok", F.col("n_failed") == 0)


def no_duplicates(label: str, df: DataFrame, keys: Sequence[str]) -> EmptyCheck:
    return EmptyCheck(label, duplicates(df, keys))


def not_empty(label: str, df: DataFrame) -> ValueCheck:
    return ValueCheck(label, df.agg(F.count(F.lit(1)).alias("n")), F.col("n") > 0)


def same_ranking(label: str, published: DataFrame, derived: DataFrame) -> EmptyCheck:
    """Both rankings hold the same rows at the same ranks; a failure names table, rank and what differs."""
    keys = [c for c in ("table", "rank") if c in published.columns]
    return EmptyCheck(label, differences(published, derived.select(*published.columns), keys))


def free_of(label: str, df: DataFrame, marker: str) -> RowChecks:
    """No text column of any row holds ``marker``."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return RowChecks(df, {label: ~F.contains(F.concat_ws(" ", *texts), F.lit(marker))})


def display_name_rules(names: DataFrame, raw: str, shown: Column, shown_twice: Column,
                       category: Column, shown_category: Column, coded: Column) -> RowChecks:
    """A display name keeps the category, loses only a leading code, and is never empty."""
    return RowChecks(names, {
        "display name keeps the category": category == shown_category,
        "only a leading code is stripped": coded | (shown == squish(raw)),
        "display name is idempotent": shown_twice == shown,
        "display name is never empty": F.length(shown) > 0,
    })


def geocode_key_rules(keys: DataFrame, zipped: Column, key: Column, plain_key: Column) -> RowChecks:
    """A key with a ZIP never changes, no key is NULL, no recovered ZIP appears twice."""
    return RowChecks(keys, {
        "keys with a ZIP are unchanged": zipped.isNull() | (key == plain_key),
        "no key is NULL": key.isNotNull(),
        "no ZIP stands twice in a key": ~F.rlike(key, F.lit(r"\b(7[0-9]{4})\b.*\b\1\b")),
    })


def verification_sheet(
    published: DataFrame, records: DataFrame, key: str, score: str, counts: Column,
) -> DataFrame:
    """Every record of every published entity, with its mean recomputed from them.

    Joined on the id, never on the name. ``counts`` says which records enter the mean.
    """
    ids = published.select(key, "rank", F.col("mean_score").alias("published_mean"),
                           F.col("n").alias("published_n"))
    history = records.withColumn("counted", F.coalesce(counts, F.lit(False))).join(
        ids, key
    )
    recomputed = history.groupBy(key, "rank").agg(
        F.count_if("counted").alias("recomputed_n"),
        F.avg(F.when(F.col("counted"), F.col(score))).alias("recomputed_mean"),
    )
    matches = (F.bround("recomputed_mean", 2) == F.col("published_mean")) & (
        F.col("recomputed_n") == F.col("published_n")
    )
    return history.join(recomputed, [key, "rank"]).withColumn(
        "matches", F.coalesce(matches, F.lit(False))
    )
