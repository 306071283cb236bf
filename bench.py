"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_QUERIES
(comma-separated keys, default: the list below plus the full pipeline) select the run.
Every query runs once, completely, in the order given, in one session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans import registry
from tidemark.plans.pipeline import run_analysis
from tidemark.session import build_session

PIPELINE = "full_pipeline"
HEADLINE = [
    "orders_clean",
    "items_clean",
    "customer_stats",
    "order_gaps",
    "purchase_intervals",
    "product_mix",
    "pareto_quintiles",
    "rfm_segments",
    "cohort_retention",
    "cohort_revenue",
    "ml_features",
    "rfm_percentile_scores",
    "pareto_curve",
    "ltv_heuristic",
    "roc_auc",
    "report_kpis",
    "dashboard_segment_table",
    "customer_explorer",
    PIPELINE,
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        if name == PIPELINE:  # all models at their documented sizes, with cross-validation
            run_analysis(registry.workspace(spark, sf_dir)).kpis().collect()
        else:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
