"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is evaluated in full into the noop sink: one warm-up, then the median of three.
"""

import json
import os
import statistics
import sys
import time

from recordlens.plans.whole import QUERIES
from recordlens.session import build_session

HEADLINE = [
    "latest_per_key", "band_counts", "score_profile", "top_ranked", "rank_tables", "union_dedupe",
    "merge_loses_nothing", "merge_report", "annotate_missing", "entity_profile", "same_date_conflicts",
    "weekly_summary", "name_keys", "address_rules", "categorize", "squish_text", "tier_match",
    "corroborated_match", "handoff_merges", "review_queue", "geocode_coverage", "geocode_retry_pass",
    "spiral_offsets", "dictionary_codes", "window_audit", "page_records", "checks", "verification_sheet",
    "merged_inspections", "map_table",
]


def run(spark, name, sf_dir):
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        # Call sites on every column are for error messages; collecting them slows plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
