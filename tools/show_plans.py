"""Print the final (post-AQE) physical plans of the main steps, trimmed to
operator names and keys, for PLANS.md.

    python tools/show_plans.py [sf_dir] > plans.txt
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from itemwise.plans import catalog  # noqa: E402
from itemwise.plans.recommend import recommend  # noqa: E402
from itemwise.plans.similarity import item_similarity  # noqa: E402
from itemwise.session import local_session, materialize  # noqa: E402
from itemwise.sinks import source_recom  # noqa: E402
from itemwise.sources import fixtures as fx  # noqa: E402
from itemwise.operators import vector_topk  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Aggregate|WindowGroupLimit|Window |Generate|Scan|Sort \[|"
                  r"QueryStage|Reused|FlatMapGroupsInPandas|Union|Filter|AQEShuffleRead)")


def trim(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            out.append(line[:170])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8, app="itemwise-plans")
    hist = materialize(catalog._hist(spark, sf))
    sim = item_similarity(hist, catalog.PROD)
    steps = {"similarity lists (E1)": sim}
    simm = materialize(item_similarity(hist, catalog.PROD))
    recs = recommend(hist, simm, catalog._labels(spark, sf), catalog.PROD)
    steps["recommend + production layout (E2, K6)"] = source_recom(
        hist.select("user_id").distinct(), recs)
    steps["vector top-K (E4)"] = vector_topk(fx.embeddings(spark, sf), "vec_id", "embedding", 10)
    steps["interactions from whole tables (F1)"] = catalog._hist(spark, sf)
    for name, df in steps.items():
        df.collect()
        print(f"### {name}\n\n```")
        print(trim(df._jdf.queryExecution().executedPlan().toString()))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
