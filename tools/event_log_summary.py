"""Summarise a Spark event log: per-stage task count, longest task, run and CPU time.

    BENCH_EVENT_LOG=1 python bench.py      # prints the event-log folder on stderr
    python tools/event_log_summary.py <event-log folder>

Reads plain or zstd-compressed rolling event logs (``eventlog_v2_*/events_*``).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import sys

import zstandard


def events(folder: str):
    files = sorted(glob.glob(f"{folder}/eventlog_v2_*/events_*")) + sorted(glob.glob(f"{folder}/local-*"))
    for path in files:
        data = open(path, "rb").read()
        if path.endswith(".zstd"):
            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)).read()
        for line in data.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    tasks: dict[int, list] = collections.defaultdict(list)
    stages: dict[int, tuple] = {}
    for e in events(sys.argv[1]):
        if e["Event"] == "SparkListenerTaskEnd":
            info, metrics = e["Task Info"], e.get("Task Metrics", {})
            tasks[e["Stage ID"]].append(
                (info["Finish Time"] - info["Launch Time"], metrics.get("Executor Run Time", 0),
                 metrics.get("Executor CPU Time", 0) / 1e6)
            )
        elif e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:48], si.get("Completion Time", 0) - si.get("Submission Time", 0))
    print(f"{'stage':>5} {'wall ms':>8} {'tasks':>5} {'max ms':>7} {'run ms':>8} {'cpu ms':>8}  name")
    for sid in sorted(stages):
        ts = tasks.get(sid) or [(0, 0, 0)]
        name, wall = stages[sid]
        print(f"{sid:>5} {wall:>8} {len(ts):>5} {max(t[0] for t in ts):>7} {sum(t[1] for t in ts):>8} "
              f"{round(sum(t[2] for t in ts)):>8}  {name}")


if __name__ == "__main__":
    main()
