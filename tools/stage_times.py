"""Summarise stage durations from a Spark event log folder (as written by
``BENCH_EVENT_LOG_DIR=... python bench.py``).

    python tools/stage_times.py <event-log-dir> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def stage_rows(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True))
    for f in files:
        if os.path.isdir(f):
            continue
        for line in _lines(f):
            if '"SparkListenerStageCompleted"' not in line:
                continue
            info = json.loads(line)["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                yield (info["Completion Time"] - info["Submission Time"], info["Stage ID"],
                       info["Number of Tasks"], info["Stage Name"])


def _lines(path: str):
    """Lines of a plain or zstd-compressed event log file."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, errors="replace")
    else:
        with open(path, errors="replace") as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stage_rows(path), reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows)} ms in total")
    for ms, sid, tasks, name in rows[:top]:
        print(f"{ms:8d} ms  stage {sid:5d}  tasks {tasks:5d}  {name[:70]}")


if __name__ == "__main__":
    main()
