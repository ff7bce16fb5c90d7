"""Run one registered query with Spark's event log written to a scratch
folder, then list its slowest stages (wall time, tasks, rows, run time).

    python tools/profile_stages.py QUERY [sf_dir] [event_log_dir]

The event log folder defaults to a fresh ``mktemp``-style directory.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from itemwise.plans import catalog  # noqa: E402
from itemwise.session import local_session  # noqa: E402

METRICS = {
    "internal.metrics.executorRunTime": "run_ms",
    "internal.metrics.input.recordsRead": "in",
    "internal.metrics.shuffle.read.recordsRead": "shuffle_in",
    "internal.metrics.shuffle.write.recordsWritten": "shuffle_out",
}


def _events(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "*", "events*")) +
                       glob.glob(os.path.join(folder, "events*"))):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            if line.startswith("{"):
                yield json.loads(line)


def main(argv: list[str]) -> None:
    name = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    folder = argv[3] if len(argv) > 3 else tempfile.mkdtemp(prefix="itemwise-events-")
    spark = local_session(8, 8, app="itemwise-profile",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": folder})
    t0 = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    print(f"{name}: {time.perf_counter() - t0:.2f}s, event log in {folder}")
    spark.stop()
    stages = []
    for e in _events(folder):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            m = {METRICS[a["Name"]]: a.get("Value") for a in si.get("Accumulables", [])
                 if a["Name"] in METRICS}
            wall = si.get("Completion Time", 0) - si.get("Submission Time", 0)
            stages.append((wall, si["Stage ID"], si["Number of Tasks"], m))
    for wall, sid, tasks, m in sorted(stages, reverse=True)[:12]:
        print(f"stage {sid:4d} {wall:7d} ms {tasks:4d} tasks {m}")


if __name__ == "__main__":
    main(sys.argv)
