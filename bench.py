"""Times headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from lodestar.plans import catalog

HEADLINE = (
    "asof_attribution", "candidate_labels", "token_df", "bm25_topk", "search_boosted", "cooccurrence_npmi", "core_skill_rates",
    "graph_edges", "validate_dangling_edges", "retrieve_two_hop", "rank_metrics", "zscore_baseline", "canonicalize_audit", "embedding_topk",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="lodestar-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", shared).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for t in ("documents", "lineitem", "events"):
        spark.read.parquet(f"{sf}/{t}.parquet").count()
    took = {}
    for name in HEADLINE:
        start = time.time()
        catalog.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
