"""Bench: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from itemwise.plans import catalog  # noqa: E402
from itemwise.session import local_session  # noqa: E402

HEADLINE = [
    "cooccurrence",             # A1: every co-occurring ordered pair
    "topn_similar_normalized",  # E1: the similarity lists of the job
    "score_candidate_side",     # J5: every unseen candidate scored
    "sink_source_recom",        # E2 + K6: the production job, end to end
    "sink_scored_list",         # E3 + K7: the vector job, end to end
    "vector_topk",              # E4 dense: exact top-10 cosine over embeddings
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="itemwise-bench")
    # warm-up: JVM, parquet footers, Python workers (one-time process start)
    catalog.QUERIES["item_popularity"](spark, sf_dir).write.format("noop").mode(
        "overwrite").save()
    spark.range(0, 1000, numPartitions=int(cpus)).mapInPandas(
        lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
