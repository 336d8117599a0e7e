"""Planning and auditing of incremental fetch windows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V


def window_plan(
    bounds: DataFrame, start: str, end: str, days: int = V.FETCH_WINDOW_DAYS
) -> DataFrame:
    """Fixed windows covering [start, end] of every row of ``bounds``; the last one is clipped.

    No windows where ``start`` is after ``end``, as for a feed that is up to date.
    """
    step = F.expr(f"interval {days} days")
    starts = F.explode(F.sequence(F.col(start), F.greatest(start, end), step)).alias("from_day")
    return bounds.filter(F.col(start) <= F.col(end)).select(F.col(end).alias("_end"), starts).select(
        "from_day", F.least(F.date_add("from_day", days - 1), "_end").alias("to_day")
    )


def incremental_start(df: DataFrame, date: str, look_back: int = 0) -> DataFrame:
    """One row with the day to resume from: the day after the newest one, less a look-back."""
    return df.agg(F.date_add(F.max(date), 1 - look_back).alias("from_day"))


def window_audit(
    log: DataFrame, window: str = "window", page: int = V.FETCH_PAGE_ROWS,
    cap: int = V.FETCH_RESULT_CAP,
) -> DataFrame:
    """State of every window from its request log.

    Only an explicit end or a short page completes a window. Reaching the result cap on full
    pages means it was truncated, and a fault as the last word means it failed. Rows are the
    newest successful answer per offset, so a retried window is not counted twice.
    """
    per_page = log.groupBy(window, "start").agg(
        F.max_by("n", F.when(F.col("outcome") == "ok", F.struct("ts", "n"))).alias("_n"),
        F.count_if(F.col("outcome") == "fault").alias("_faults"),
        F.max(F.struct("ts", "start", "outcome", "n")).alias("_last"),
    )
    audited = per_page.groupBy(window).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n"),
        F.sum("_faults").alias("n_faults"),
        F.max("_last").alias("_last"),
    )
    last_ok = F.col("_last.outcome") == "ok"
    state = (
        F.when(F.col("_last.outcome") == "end", "done")
        .when(last_ok & (F.col("_last.n") < page), "done")
        .when(last_ok & (F.col("_last.start") + page >= cap), "capped")
        .when(last_ok, "interrupted")
        .otherwise("failed")
    )
    return audited.select(window, state.alias("state"), "n", "n_faults")


def window_status(plan: DataFrame, audited: DataFrame, duplicates: DataFrame, plan_key: str, window: str) -> DataFrame:
    """One row per planned window: its days, state ("planned" before any request), rows, surplus copies and faults."""
    audit = audited.select(F.col(window).alias(plan_key), "state", "n", "n_faults")
    surplus = duplicates.select(F.col(window).alias(plan_key), "dup")
    none = F.lit(0).cast("long")
    return plan.join(audit, plan_key, "left").join(surplus, plan_key, "left").select(
        plan_key, "from_day", "to_day", F.coalesce("state", F.lit("planned")).alias("state"),
        F.coalesce("n", none).alias("n"), F.coalesce("dup", none).alias("dup"),
        F.coalesce("n_faults", none).alias("n_faults"))


def pending_windows(plan: DataFrame, audited: DataFrame, plan_key: str, window: str) -> DataFrame:
    """Planned windows not yet done."""
    done = audited.filter("state = 'done'").select(F.col(window).alias(plan_key))
    return plan.join(done, plan_key, "left_anti")


def duplicate_ids(records: DataFrame, window: str, ident: str) -> DataFrame:
    """Surplus copies of record ids per window, counted on the raw pages."""
    per_id = records.groupBy(window, ident).agg(F.count(F.lit(1)).alias("_n"))
    return per_id.groupBy(window).agg(F.sum(F.col("_n") - 1).alias("dup"))
