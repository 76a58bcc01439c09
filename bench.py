"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores),
BENCH_RUNS (default 3, after one warm-up), BENCH_QUERIES (default the list
below, ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelight.constants import F1_GATE  # noqa: E402
from parcelight.plans import scoring  # noqa: E402
from parcelight.session import build_session  # noqa: E402
from parcelight.storage import ensure_local_folder  # noqa: E402
from workload import views  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    # whole stages
    "etl_hot_leads", "etl_build_leads", "etl_clean_leads", "etl_features",
    "etl_leads_from_files", "export_format",
    # operators
    "prep_improvements", "prep_history", "prep_sales", "clean_jv_iqr",
    "clean_act_year", "feat_neighborhood_ratio", "feat_hot_lead", "score_rank",
    "sink_append_ignore_dups", "agg_summary_stats", "agg_value_counts",
    "profile_join_coverage", "profile_describe", "diag_fold_top_values",
    "ml_fold_metrics", "log_latest_status",
]


def run(name: str, spark, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def train(spark, sf_dir: str) -> float:
    """Fit, held-out test and gate with the default 200 trees of depth 4; once,
    without the cross-validation."""
    rows = views.features(spark, sf_dir)
    begin = time.perf_counter()
    trained = scoring.train(rows, cv_folds=0)
    if trained.f1 < F1_GATE:
        raise RuntimeError(f"F1 {trained.f1} below the gate")
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split() or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    ensure_local_folder(spark)

    # Stage queries read the table of the stage before them. Building these
    # tables is timed on its own, from cold.
    stages = {}
    for table in ("leads", "leads_clean", "leads_features"):
        begin = time.perf_counter()
        views.stage(spark, sf_dir, table)
        stages[table] = round(time.perf_counter() - begin, 3)

    timed = {}
    for name in (n for n in names if n != "train_200_trees"):
        run(name, spark, sf_dir)
        timed[name] = round(
            statistics.median(run(name, spark, sf_dir) for _ in range(runs)), 3
        )
    if not chosen or "train_200_trees" in names:
        timed["train_200_trees"] = round(train(spark, sf_dir), 3)
    sf = re.search(r"sf([\d.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "cold_stage_builds": stages,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
