"""Job and stage times of one query from Spark's event log (no UI needed).

Usage: python tools/stage_times.py <query> [sf_dir]
Runs the query once to warm up and once measured, with the event log
written to a fresh scratch folder, then prints job count, summed job time
and the slowest stages of the measured run.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="costlake-eventlog-")
    from costlake.plans.queries import QUERIES
    from costlake.session import build_session
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir})
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    t0 = time.time() * 1000
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    t1 = time.time() * 1000
    spark.stop()
    jobs, stages = {}, []
    for path in glob.glob(f"{logdir}/**/events_*", recursive=True) + glob.glob(f"{logdir}/*.*"):
        if not os.path.isfile(path):
            continue
        if path.endswith(".zstd"):
            import zstandard
            with open(path, "rb") as fb:
                text = zstandard.ZstdDecompressor().stream_reader(fb).read().decode("utf-8")
        else:
            with open(path) as f:
                text = f.read()
        if True:
            for line in text.splitlines():
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart" and e["Submission Time"] >= t0:
                    jobs[e["Job ID"]] = [e["Submission Time"], None]
                elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                    jobs[e["Job ID"]][1] = e["Completion Time"]
                elif ev == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    if info.get("Submission Time", 0) >= t0 and "Completion Time" in info:
                        stages.append((info["Completion Time"] - info["Submission Time"], info["Stage Name"][:60],
                                       info["Number of Tasks"]))
    busy = sum((b - a) for a, b in jobs.values() if b)
    print(f"{name}: wall {(t1 - t0) / 1000:.2f}s, {len(jobs)} jobs, {busy / 1000:.2f}s inside jobs, "
          f"{len(stages)} stages")
    for dur, sname, ntasks in sorted(stages, reverse=True)[:8]:
        print(f"  {dur / 1000:6.2f}s  {ntasks:4d} tasks  {sname}")


if __name__ == "__main__":
    main()
