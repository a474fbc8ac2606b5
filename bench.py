"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query runs once to warm up the JVM and once for the clock; the result is counted
through a noop write, so all columns are computed and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.catalog import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "group_aggs",
    "join_chain",
    "describe_stats",
    "user_item_rating",
    "trending_top20",
    "rating_baselines",
    "user_similarity",
    "knn_predict",
    "hybrid_top20",
    "content_top10",
    "eval_user_run",
    "knn_classify",
    "doc_term_ngrams",
    "union_branches",
    "sink_history",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, max(cores, 1), os.environ.get("BENCH_MEMORY", "12g"))
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
