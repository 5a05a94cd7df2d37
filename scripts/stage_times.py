"""Summarise a Spark event log per job description (bench query name).

usage: python scripts/stage_times.py <event log file or rolling event-log directory> [query]
Prints, per query: jobs, stages, tasks, summed stage wall time and summed task run time.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def event_lines(path: str):
    """Lines of a plain event log, or of a rolling (v2) event-log directory."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for fp in files:
        if fp.endswith(".zstd"):          # Spark's default event-log codec
            import io

            import zstandard
            with open(fp, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def detail(path: str, query: str) -> None:
    """Per stage of one query: name, tasks, wall time, summed task run time."""
    job_desc, stage_job, task_ms = {}, {}, defaultdict(int)
    stages = []
    for line in event_lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            job_desc[e["Job ID"]] = (e.get("Properties") or {}).get("spark.job.description", "?")
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif ev == "SparkListenerTaskEnd":
            task_ms[e.get("Stage ID")] += (e.get("Task Metrics") or {}).get("Executor Run Time", 0)
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if job_desc.get(stage_job.get(info["Stage ID"])) == query and "Completion Time" in info:
                stages.append((info["Stage ID"], info["Stage Name"][:60], info.get("Number of Tasks", 0),
                               info["Completion Time"] - info["Submission Time"]))
    for sid, name, n, ms in stages:
        print(f"stage {sid:4d} tasks {n:3d} wall {ms:6d} ms  task {task_ms[sid]:7d} ms  {name}")


def main() -> None:
    path = sys.argv[1]
    if len(sys.argv) > 2:
        detail(path, sys.argv[2])
        return
    job_desc, stage_job = {}, {}
    per = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "stage_ms": 0, "task_ms": 0})
    for line in event_lines(path):
        if True:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "?")
                job_desc[e["Job ID"]] = desc
                per[desc]["jobs"] += 1
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                desc = job_desc.get(stage_job.get(info["Stage ID"]), "?")
                if "Completion Time" in info and "Submission Time" in info:
                    per[desc]["stages"] += 1
                    per[desc]["tasks"] += info.get("Number of Tasks", 0)
                    per[desc]["stage_ms"] += info["Completion Time"] - info["Submission Time"]
            elif ev == "SparkListenerTaskEnd":
                desc = job_desc.get(stage_job.get(e.get("Stage ID")), "?")
                m = e.get("Task Metrics") or {}
                per[desc]["task_ms"] += m.get("Executor Run Time", 0)
    print(f"{'query':28s} {'jobs':>5s} {'stages':>7s} {'tasks':>6s} {'stage_ms':>9s} {'task_ms':>8s}")
    for k, v in sorted(per.items()):
        print(f"{k:28s} {v['jobs']:5d} {v['stages']:7d} {v['tasks']:6d} {v['stage_ms']:9d} {v['task_ms']:8d}")


if __name__ == "__main__":
    main()
