"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query is timed twice and the better time is kept. The profile and model queries read the
labelled table as a stage output (written once, as in the pipeline); `model_dataset` times its build.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderflow.ml import models  # noqa: E402
from orderflow.plans import queries as catalogue  # noqa: E402
from orderflow.plans.delivery import CONTRACT  # noqa: E402
from orderflow.session import build_session  # noqa: E402

HEADLINE = [
    "pk_check",
    "fk_check_all",
    "totals_reconcile",
    "order_item_rollup",
    "payment_rollup",
    "model_dataset",
    "chronological_split",
    "line_quantiles",
    "histogram",
    "roc_auc",
    "average_precision",
    "threshold_sweep",
]
ON_MODEL = ["numerical_summary", "categorical_summary", "target_by_quartile", "numeric_drift", "spearman_pairs"]
RUNS = 2


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "orderflow-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="20g",
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        seconds[name] = best(lambda: noop(catalogue.QUERIES[name](spark, sf_dir)))
    catalogue.split_model(spark, sf_dir)
    for name in ON_MODEL:
        seconds[name] = best(lambda: noop(catalogue.QUERIES[name](spark, sf_dir)))
    ready = catalogue.parts(spark, sf_dir)
    start = time.perf_counter()
    prepared = models.prepare(CONTRACT, ready["train"], ready["validation"])
    seconds["fit_preparation"] = round(time.perf_counter() - start, 3)
    late = models.compare_classifiers(prepared, catalogue.CLASSIFIERS)
    days = models.compare_regressors(prepared, catalogue.COMPARED_REGRESSORS)
    per_row = {}
    for comparison in (late, days):
        for row in comparison.metrics.collect():
            seconds[f"fit_{row['model_name']}"] = round(row["training_seconds"], 3)
            per_row[row["model_name"]] = round(row["inference_ms_per_order"], 5)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "inference_ms_per_order": per_row,
                "train_rows": prepared.train.count(),
                "lineitem_rows": lines,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
