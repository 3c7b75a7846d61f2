"""Summarise stage times from a Spark event log folder (written by bench.py with BENCH_EVENTLOG_DIR).

usage: python scripts/stage_times.py <event log dir> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def events(root):
    for dirpath, _, files in os.walk(root):
        for f in sorted(files):
            if f.startswith("events_") or f.startswith("local-") or f.startswith("app-"):
                for line in _lines(os.path.join(dirpath, f)):
                    try:
                        yield json.loads(line)
                    except ValueError:
                        continue


def main():
    root, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(root):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            stages.append((dur, info["Stage ID"], info.get("Number of Tasks"), info.get("Stage Name", "")[:80]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.1f} s in total")
    for dur, sid, ntask, name in stages[:top]:
        print(f"{dur:8.2f}s  stage {sid:5d}  tasks {ntask:5d}  {name}")


if __name__ == "__main__":
    main()
