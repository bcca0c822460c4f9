"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

import json
import os
import re
import time

from pyspark.sql import SparkSession

from termloom.plans import registry

HEADLINE = ["quality_flags", "pipe_tables", "date_normalize", "week_references", "period_references", "plan_rows_by_date", "adjacent_events", "evaluate_labels", "method_metrics", "candidate_labels", "minhash_clusters"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        began = time.time()
        registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(scale[1]) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
