"""Summarise a Spark event log: per stage its tasks, skew and bytes. Usage: stage_report.py FILE [min seconds]"""

from __future__ import annotations

import json
import statistics
import sys
from collections import defaultdict


def report(path: str, least: float = 1.0) -> None:
    tasks = defaultdict(list)
    names = {}
    totals = defaultdict(int)
    with open(path) as lines:
        for line in lines:
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageCompleted":
                info = event["Stage Info"]
                scopes = [json.loads(r["Scope"])["name"] for r in info["RDD Info"] if r.get("Scope")]
                names[info["Stage ID"]] = ", ".join(dict.fromkeys(scopes))
            if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                m = event["Task Metrics"]
                written = m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                rows = m["Shuffle Read Metrics"]["Total Records Read"]
                spilled = m["Disk Bytes Spilled"]
                tasks[event["Stage ID"]].append((m["Executor Run Time"] / 1000, written, rows, spilled))
                totals["shuffle"] += written
                totals["spill"] += spilled
                totals["input"] += m["Input Metrics"]["Bytes Read"]
                totals["output"] += m["Output Metrics"]["Bytes Written"]
    print("stage tasks  total_s  max_s  median_s  shuffle_MB  max_rows  median_rows  spill_MB  operators")
    for stage in sorted(tasks):
        t = tasks[stage]
        seconds, rows = [x[0] for x in t], [x[2] for x in t]
        if sum(seconds) < least:
            continue
        print(
            f"{stage:5d} {len(t):5d} {sum(seconds):8.1f} {max(seconds):6.1f} {statistics.median(seconds):9.1f} "
            f"{sum(x[1] for x in t) / 1e6:11.1f} {max(rows):9d} {int(statistics.median(rows)):12d} "
            f"{sum(x[3] for x in t) / 1e6:9.1f}  {names.get(stage, '')[:110]}"
        )
    print({k: f"{v / 1e6:.1f} MB" for k, v in totals.items()})


if __name__ == "__main__":
    report(sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 1.0)
