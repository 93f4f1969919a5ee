"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores,
BENCH_QUERIES (comma list) other queries than the headline ones. Loading the
interactions is timed as a stage of its own, as ``load_interactions``; every query
reads that table and builds whatever else it needs.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from cartwise.plans import catalog
from cartwise.session import RECOMMENDED_CONF

HEADLINE = (
    "item_stats",
    "item_cooccurrence",
    "category_transitions",
    "neg_uniform",
    "neg_popular",
    "engineer_features",
    "feat_cart_cooccurrence",
    "user_embedding",
    "user_item_similarity",
    "similar_items",
    "topk_per_group",
    "ranking_report",
    "evaluate",
    "bootstrap_ci",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in RECOMMENDED_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JVM and the Python workers.
    catalog.QUERIES["ranking_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    catalog.forget()
    start = time.perf_counter()
    catalog.interactions(spark, sf_dir)
    seconds = {"load_interactions": round(time.perf_counter() - start, 3)}
    for name in names:
        catalog.forget(keep=("interactions",))
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
