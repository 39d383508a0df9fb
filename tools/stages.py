"""Per-stage timings of one registered query, read from Spark's event log.

Runs the query (full result to the ``noop`` sink) in a session whose event
log goes to a fresh scratch folder, then prints per stage: tasks, wall time,
summed executor run and CPU time, GC time, shuffle records read and written.
No UI or server is started.

Usage: python tools/stages.py QUERY [sf_dir] [runs]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _read_events(folder: str):
    for path in sorted(glob.glob(f"{folder}/*/events_*") + glob.glob(f"{folder}/*")):
        if os.path.isdir(path) or "appstatus" in path:
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main(name: str, sf_dir: str = "/root/testdata/sf0.1", runs: int = 2) -> None:
    from pyspark.sql import SparkSession

    from masklens.plans.catalog import QUERIES
    from masklens.session import SQL_CONF

    folder = tempfile.mkdtemp(prefix="masklens-events-")
    builder = (SparkSession.builder.master("local[8]").appName("masklens-stages")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", folder))
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for i in range(runs):
        spark.sparkContext.setJobGroup(f"run{i}", name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    last = f"run{runs - 1}"
    job_group, stage_job, stages, tasks = {}, {}, {}, {}
    for e in _read_events(folder):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            job_group[e["Job ID"]] = props.get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = si
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            t = tasks.setdefault(e["Stage ID"], [0, 0, 0, 0, 0])
            t[0] += m.get("Executor Run Time", 0)
            t[1] += m.get("Executor CPU Time", 0) // 1_000_000
            t[2] += m.get("JVM GC Time", 0)
            t[3] += (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            t[4] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
    print(f"{name} on {sf_dir}, last of {runs} runs; event log in {folder}")
    print(f"{'stage':>5} {'tasks':>5} {'wall ms':>8} {'run ms':>8} {'cpu ms':>8} {'gc ms':>6} {'sh read':>9} {'sh write':>9}  name")
    for sid in sorted(stages):
        if job_group.get(stage_job.get(sid)) != last:
            continue
        si = stages[sid]
        wall = si.get("Completion Time", 0) - si.get("Submission Time", 0)
        run, cpu, gc, rd, wr = tasks.get(sid, [0] * 5)
        print(f"{sid:>5} {si['Number of Tasks']:>5} {wall:>8} {run:>8} {cpu:>8} {gc:>6} {rd:>9} {wr:>9}  "
              f"{si['Stage Name'][:40]}")


if __name__ == "__main__":
    args = sys.argv[1:]
    if not args:
        sys.exit(__doc__)
    main(args[0], *(args[1:2] or []), *([int(args[2])] if len(args) > 2 else []))
