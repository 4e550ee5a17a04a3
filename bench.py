"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caselake.plans.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "daily_metrics", "daily_ma7_calendar", "monthly_metrics", "kpi_snapshot", "category_mix",
    "place_month_matrix", "fact_summary", "parse_date_multi", "decode_codes", "derive_flags",
    "pii_vault", "masked_view", "surrogate_keys", "dim_date", "dim_profile", "fact",
    "orphan_counts", "rollup_by_dimension", "capacity_rollup", "capacity_use", "dedup_latest",
    "dedup_case_versions", "drop_duplicates_by", "scd2_first_load", "scd2_merge", "rules_all",
    "rules_uniqueness", "quality_log_by_run", "latest_complete_run", "inherit_alerts",
    "blocked_terms", "pii_detect", "correct_terms", "prepare_context", "audit_log",
    "kpi_with_alerts", "ingest_stream", "compact_and_cluster", "stages_gold", "stages_beds",
    "scd2_table_roundtrip", "overwrite_table", "gold_checks", "news_log",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("caselake-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    REGISTRY["fact_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    scale = float(name) if name.replace(".", "", 1).isdigit() else name
    seconds = {}
    for query in wanted:
        start = time.perf_counter()
        REGISTRY[query](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[query] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_wall_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
