"""Summarise a Spark event log: per job, its stages with task count,
duration and shuffle read / write (no UI needed).

usage: python tools/stage_times.py <event-log file or folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path):
    """An event-log file, or a rolling event-log folder (``events_*`` files)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    else:
        files = [path]
    for fp in files:
        if fp.endswith(".zstd"):          # Spark 4 compresses event logs with zstd
            import io

            import zstandard
            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    for line in _lines(path):
        if line.strip():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
                stages[info["Stage ID"]] = (dur, info["Number of Tasks"], info["Stage Name"][:60],
                                            acc.get("internal.metrics.shuffle.read.recordsRead", 0),
                                            acc.get("internal.metrics.shuffle.write.recordsWritten", 0))
    print(f"{'stage':>5} {'ms':>7} {'tasks':>5} {'shuf_in':>9} {'shuf_out':>9}  name")
    for sid, (dur, n, name, rin, rout) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        print(f"{sid:>5} {dur:>7} {n:>5} {rin or 0:>9} {rout or 0:>9}  {name}")


if __name__ == "__main__":
    main()
