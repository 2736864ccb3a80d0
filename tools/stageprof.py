"""Per-stage profile of one registered query from Spark's event log (no UI involved).

usage: python tools/stageprof.py QUERY [SF_DIR]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarterdeck.plans.catalog import QUERIES  # noqa: E402
from quarterdeck.session import build_session  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="qd-evlog-")
    spark = build_session(
        "local[8]", extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                               "spark.eventLog.compress": "false"}
    )
    if name in QUERIES:
        build = QUERIES[name]
    else:  # a building block, e.g. catalog.bronze_sales
        from quarterdeck.plans import catalog

        build = getattr(catalog, name.split(".", 1)[-1])
    build(spark, sf).write.format("noop").mode("overwrite").save()  # warm
    t0 = time.time()
    build(spark, sf).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()
    paths = sorted(p for p in glob.glob(f"{logdir}/**/*", recursive=True) if os.path.isfile(p))
    stages, tasks = {}, {}
    start_ms = t0 * 1000
    lines = (ln for p in paths for ln in open(p))
    for line in lines:
        if not line.startswith("{"):
            continue
        ev = json.loads(line)
        if ev["Event"] == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            if si.get("Submission Time", 0) < start_ms:
                continue
            stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"],
                                      si["Completion Time"] - si["Submission Time"])
        if ev["Event"] == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            sid = ev["Stage ID"]
            agg = tasks.setdefault(sid, [0, 0, 0])
            agg[0] += m.get("Executor Run Time", 0)
            agg[1] = max(agg[1], m.get("Executor Run Time", 0))
            agg[2] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Write Time", 0) // 1_000_000
    print(f"{name}: wall {wall:.2f}s")
    for sid in sorted(stages):
        nm, nt, ms = stages[sid]
        run, mx, sw = tasks.get(sid, [0, 0, 0])
        print(f"  stage {sid:3d} tasks {nt:3d} wall {ms:6d}ms  sum-run {run:6d}ms  max-task {mx:6d}ms  shuffle-write {sw:5d}ms  {nm}")


if __name__ == "__main__":
    main()
