"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the
number of local threads.  Each query is built and run to its end once after a
short warm-up of the session; ``value`` is the sum of the seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from loanlens.session import use_recommended  # noqa: E402
from testbed import all_queries  # noqa: E402
from testbed.storage import with_storage  # noqa: E402

HEADLINE = [
    "transaction_scan",
    "clean_fill_replace",
    "share_of_total",
    "module_scoring_outside_model",
    "woe_lr_score",
    "module_left_joins",
    "decided_rows",
    "verdicts_by_band",
    "lr_blend",
    "policy_cascade",
    "upsert_master",
    "asof_latest_run",
    "labelled_master",
    "fact_right_join",
    "gini_overall",
    "gini_row_writeback",
    "ks_fixed",
    "ks_equal_width",
    "psi_numeric_quantile",
    "psi_categorical",
    "psi_monthly_report",
    "kl_divergence",
    "json_path_extract",
    "offer_drift_report",
    "module_scoring_trees",
    "upsert_full_master",
    "fact_right_join_full",
    "job_gini",
    "job_ks",
    "job_drift",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    use_recommended(with_storage(spark)).sparkContext.setLogLevel("ERROR")
    queries = all_queries()[0]
    queries["risk_bands"](spark, sf_dir).count()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
