"""Time the headline queries: python bench.py prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the threads."""

import json
import os
import time

from pyspark.sql import SparkSession

from kinmesh.plans.catalogue import queries, run_of

#: Stages of the linkage, each timed as it is made and written, under the name of the query that reads it.
STAGES = {"fragments": "normalise_name_address", "idf": "token_idf", "char": "char_tfidf_topk", "bm25": "bm25_topk", "key-hits": "key_candidates", "fused": "rrf_fusion"}
HEADLINE = ["pair_completeness", "pair_features_all", "softmax_null", "expected_f05_decode", "macro_f05", "submission_rows", "dense_topk", "script_census", "orphan_report"]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    of, took = queries(), {}
    linked = run_of(spark, folder).linked
    linked.own_fused  # made with all that it reads
    stages = linked.seconds
    took |= {name: round(stages[part], 3) for part, name in STAGES.items()}
    for name in HEADLINE:
        began = time.time()
        of[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
