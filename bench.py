"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    # sources and columns
    "parquet_scan", "monthly_sheet", "sniff_encoding", "period_month", "code_variants", "slugify", "squeeze", "fix_mojibake",
    # schema and reshape
    "union_by_name", "column_coverage", "unique_names", "grid_to_long", "grid2_to_long", "pivot_years",
    # joins and labels
    "label_state", "join_many_to_one", "join_salted_lookup", "merge_dictionary", "apply_labels", "label_quality", "deflate_items",
    # aggregates and profiles
    "to_quarterly", "distinct_counts", "describe", "center_stats", "keep_first", "temporal_profile", "corr_matrix", "single_partner",
    # series, regressions, marts, codebook
    "revenue_panel", "yoy_growth", "rank_by", "ols_log_rows", "ols_diagnostics", "state_ranking", "nation_and_leaders", "fiscal_quarterly_ratios",
    "fiscal_elasticities", "page_anchors", "codebook",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from suite import registered

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = registered()
    # One run before the clock starts, so that the first query does not pay for the JVM.
    found["revenue_panel"][0](spark, sf).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        found[name][0](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf).name,
    }))


if __name__ == "__main__":
    main()
