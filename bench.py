"""Time the headline queries.  Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list).  Every query runs to a sink that takes all rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from pyspark.sql import SparkSession  # noqa: E402

from kinfold.examples import catalogue  # noqa: E402
from kinfold.session import tune  # noqa: E402

HEADLINE = [
    "entity_stats", "indicator_pivot", "milestones", "golden_record", "code_value_fold",
    "ordered_path", "latest_per_key", "dedup_by_key", "null_safe_star", "asof_rate_join",
    "salted_join", "salted_full_join", "impute_by_group", "top_n_timeline", "timeline_json",
    "histogram_json", "name_normalise", "phonetic_block", "similar_spellings", "components",
    "resolve_people", "assign_identity", "carry_over", "profile_build", "passenger_details",
    "booker_details", "score_pairs", "unify_people", "new_identities", "revenue_breakdown",
    "near_dates", "extend_components",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = tune(SparkSession.builder.master(f"local[{cpus}]").appName("kinfold-bench")
                 .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
                 .config("spark.sql.session.timeZone", "UTC")
                 .config("spark.driver.memory", "16g")
                 .config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false")
                 .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue()
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        start = time.time()
        queries[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
