"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from minegrain.plans import catalog  # noqa: E402
from minegrain.runtime import local_session  # noqa: E402

HEADLINE = [
    "tokenize",
    "tfidf",
    "topn_terms_ctf",
    "kmeans_fit",
    "cluster_macro_f1",
    "pagerank",
    "topic_sensitive_pagerank",
    "fuse_scores",
    "user_similarity_cosine",
    "item_similarity_cosine",
    "knn_predict_item",
    "pmf_step",
    "linear_l2_squared_hinge",
    "one_vs_rest",
    "rank_svm",
    "ndcg_at_k",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    catalog.QUERIES["rmse"](spark, sf).collect()  # start the JVM's code paths before timing
    seconds = {}
    for name in names:
        start = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(f"{name} {seconds[name]}s", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
