"""Seconds per headline query on local cores; one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from tidemark.session import configure  # noqa: E402

HEADLINE = [
    "page_links", "hierarchy_flatten", "scd2_merge", "strip_affixes", "attribute_history",
    "canonicalise", "flag_latest", "keep_longest", "latest_private_value", "possible_duplicates",
    "layered_label", "rule_cascade", "unit_dim", "stints", "stints_carried", "role_history",
    "change_feed", "gap_sessions", "gap_sessions_global", "assign_session", "breakdown",
    "quality_checks",
]
RUNS = 3  # the best of these counts; the first also compiles


def seconds(spark: SparkSession, query: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[query](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    best = {q: min(seconds(spark, q, sf_dir) for _ in range(RUNS)) for q in chosen}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": {q: round(s, 3) for q, s in best.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
