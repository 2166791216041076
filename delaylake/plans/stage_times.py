"""Stage times and bytes from Spark's event log, for the benchmark's report.

The log holds one JSON event a line. Stages are attributed to the named span of wall time in
which they were submitted, which also holds for jobs that a stream runs in its own thread.
"""

from __future__ import annotations

import json
import os
from collections import defaultdict
from collections.abc import Iterable

#: Settings for a session whose log is read afterwards: one plain file for an application.
LOG_CONF = {"spark.eventLog.enabled": "true", "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false"}


def log_conf(folder: str) -> dict[str, str]:
    return {**LOG_CONF, "spark.eventLog.dir": f"file://{os.path.abspath(folder)}"}


def _bytes(metrics: dict) -> dict[str, int]:
    read, write = metrics.get("Shuffle Read Metrics", {}), metrics.get("Shuffle Write Metrics", {})
    return {"input": metrics.get("Input Metrics", {}).get("Bytes Read", 0),
            "output": metrics.get("Output Metrics", {}).get("Bytes Written", 0),
            "shuffle_write": write.get("Shuffle Bytes Written", 0),
            "shuffle_read": read.get("Remote Bytes Read", 0) + read.get("Local Bytes Read", 0),
            "spill": metrics.get("Disk Bytes Spilled", 0)}


def stages(lines: Iterable[str]) -> list[dict]:
    """A row for each completed stage: submitted (seconds), seconds, tasks, task_seconds,
    longest_task, failed_tasks and bytes. Lines that are cut off (a log still being written)
    are left out."""
    rows: dict[int, dict] = {}
    tasks: dict[int, dict] = defaultdict(lambda: defaultdict(float))
    for line in lines:
        try:
            e = json.loads(line)
        except ValueError:
            continue
        if e["Event"] == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            if "Submission Time" in i and "Completion Time" in i:
                rows[i["Stage ID"]] = {"stage": i["Stage ID"], "name": i["Stage Name"],
                                       "submitted": i["Submission Time"] / 1000,
                                       "seconds": (i["Completion Time"] - i["Submission Time"]) / 1000}
        elif e["Event"] == "SparkListenerTaskEnd":
            t, seconds = tasks[e["Stage ID"]], (e.get("Task Metrics") or {}).get("Executor Run Time", 0) / 1000
            t["tasks"] += 1
            t["failed_tasks"] += e["Task End Reason"]["Reason"] != "Success"
            t["task_seconds"] += seconds
            t["longest_task"] = max(t["longest_task"], seconds)
            for k, v in _bytes(e.get("Task Metrics") or {}).items():
                t[k] += v
    names = ["tasks", "failed_tasks", "task_seconds", "longest_task", "input", "output", "shuffle_write",
             "shuffle_read", "spill"]
    return [r | {n: tasks[k][n] for n in names} for k, r in sorted(rows.items())]


def by_span(found: list[dict], spans: dict[str, tuple[float, float]]) -> dict[str, dict]:
    """For each named span (begin, end in seconds since the epoch): stages, tasks, the seconds of
    its tasks and of its longest stage, and megabytes."""
    out = {}
    for name, (a, b) in spans.items():
        own = [r for r in found if a <= r["submitted"] <= b]
        mb = {f"{k}_mb": round(sum(r[k] for r in own) / 1e6, 1)
              for k in ("input", "output", "shuffle_write", "spill")}
        out[name] = {"stages": len(own), "tasks": int(sum(r["tasks"] for r in own)),
                     "task_sec": round(sum(r["task_seconds"] for r in own), 2),
                     "longest_stage_sec": round(max((r["seconds"] for r in own), default=0.0), 2),
                     "longest_task_sec": round(max((r["longest_task"] for r in own), default=0.0), 2), **mb}
    return out


def read_folder(folder: str) -> list[dict]:
    out = []
    for name in sorted(os.listdir(folder)):
        path = os.path.join(folder, name)
        if os.path.isfile(path):
            with open(path, errors="replace") as log:
                out += stages(log)
    return out
