"""Time the headline queries and print one JSON line.

Each query runs twice on a warm session; "queries" holds the second run and
"first_run" the first, which also compiles its code. Results are computed in
full and thrown away by the no-op sink. What a query explains (split, model of
ROUNDS trees, sample) is made before its clock starts, so that attributions are
timed alone.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ebbtide.models.learners import fit_trees  # noqa: E402
from ebbtide.models.prepare import feature_columns  # noqa: E402
from ebbtide.plans.experiments import explanation_sample  # noqa: E402
from ebbtide.registry.spark_queries import QUERIES, _bench  # noqa: E402
from ebbtide.session import clear_scratch  # noqa: E402

ROUNDS = 50

HEADLINES = [
    "churn_features",
    "churn_features_prior_round",
    "member_features",
    "transaction_features",
    "activity_features",
    "active_days",
    "quality_checks",
    "segment_rate_city_topk",
    "rate_by_renew_cancel",
    "cohort_churn_rate",
    "missingness_audit",
    "activity_medians",
    "histogram_expiry",
    "correlation_matrix",
    "stratified_split_exact",
    "metric_record",
    "roc_curve",
    "drift_report",
    "last_with_totals_by_join",
    "gated_build",
    "attributions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        if name == "attributions":
            bench = _bench(spark, sf_dir)
            if "trees" not in bench.__dict__:
                bench.trees = fit_trees(bench.train, feature_columns(bench.train), rounds=ROUNDS)
                bench.sample = explanation_sample(bench.test)
            bench.__dict__.pop("attributions", None)
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken = round(time.perf_counter() - start, 3)
        if name != "attributions":
            clear_scratch(spark)
        return taken

    wanted = sys.argv[1:] or HEADLINES
    first = {name: timed(name) for name in wanted}
    second = {name: timed(name) for name in wanted}
    rows = spark.read.parquet(*[f"{sf_dir}/{t}.parquet" for t in ("customer",)]).count()
    print(
        json.dumps(
            {
                "metric": "sum of headline query times",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "users": rows,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
