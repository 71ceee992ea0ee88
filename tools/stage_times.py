"""Summarise a Spark event log: per job group (bench query), stage wall time,
task count, task time and shuffle bytes.

Usage: python tools/stage_times.py <event-log file or folder> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def events(path: str):
    """Every event of a log file or folder (Spark 4 rolls logs into sub-folders)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if not f.startswith(("appstatus", ".")))
    else:
        files = [path]
    for f in files:
        with open(f, "rb") as raw:
            if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
                import zstandard
                stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            else:
                stream = raw
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    stage_group: dict[int, str] = {}
    stages = {}
    task_ms: dict[int, int] = defaultdict(int)
    shuffle_w: dict[int, int] = defaultdict(int)
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            stages[info["Stage ID"]] = (info.get("Stage Name", ""), info.get("Number of Tasks", 0),
                                        (end - start) if start and end else 0)
        elif kind == "SparkListenerTaskEnd":
            sid = e["Stage ID"]
            ti = e.get("Task Info", {})
            task_ms[sid] += ti.get("Finish Time", 0) - ti.get("Launch Time", 0)
            sw = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
            shuffle_w[sid] += sw.get("Shuffle Bytes Written", 0)
    by_group: dict[str, list] = defaultdict(list)
    for sid, (name, ntasks, wall) in stages.items():
        by_group[stage_group.get(sid, "-")].append((wall, sid, name, ntasks))
    for group, rows in sorted(by_group.items(), key=lambda kv: -sum(r[0] for r in kv[1])):
        total = sum(r[0] for r in rows)
        print(f"{group}: {len(rows)} stages, {total / 1000:.2f} s stage wall time")
        for wall, sid, name, ntasks in sorted(rows, reverse=True)[:top]:
            print(f"    stage {sid:5d} {wall / 1000:7.2f} s  tasks={ntasks:4d}  "
                  f"task_time={task_ms[sid] / 1000:7.2f} s  shuffle_write={shuffle_w[sid]:>11,d} B  "
                  f"{name[:60]}")


if __name__ == "__main__":
    main()
