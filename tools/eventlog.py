"""Summarise a Spark event log per job group (bench.py tags each query).

Usage: python tools/eventlog.py <event-log folder or file>
Prints, per query: jobs, stages, tasks, stage time, shuffle write / read bytes.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _acc(stage_info: dict, name: str) -> int:
    for a in stage_info.get("Accumulables", []):
        if a.get("Name") == name:
            try:
                return int(a.get("Value", 0))
            except (TypeError, ValueError):
                return 0
    return 0


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def _event_files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if n.startswith(("events_", "local-", "app-")) and not n.endswith(".crc")]
    return out


def summarise(path: str) -> dict:
    stage_group: dict[int, str] = {}
    out = defaultdict(lambda: defaultdict(int))
    for f in _event_files(path):
        if True:
            for line in _lines(f):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
                    out[group]["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"], "-")
                    o = out[group]
                    o["stages"] += 1
                    o["tasks"] += info.get("Number of Tasks", 0)
                    if info.get("Completion Time") and info.get("Submission Time"):
                        o["stage_ms"] += info["Completion Time"] - info["Submission Time"]
                    o["shuffle_write"] += _acc(info, "internal.metrics.shuffle.write.bytesWritten")
                    o["shuffle_read"] += (_acc(info, "internal.metrics.shuffle.read.remoteBytesRead")
                                          + _acc(info, "internal.metrics.shuffle.read.localBytesRead"))
    return out


def main() -> None:
    res = summarise(sys.argv[1])
    print(f"{'query':18s} {'jobs':>5s} {'stages':>6s} {'tasks':>6s} {'stage_s':>8s} {'shuf_w_MB':>9s} {'shuf_r_MB':>9s}")
    for g, o in sorted(res.items()):
        print(f"{g:18s} {o['jobs']:5d} {o['stages']:6d} {o['tasks']:6d} {o['stage_ms'] / 1000:8.1f} "
              f"{o['shuffle_write'] / 1e6:9.2f} {o['shuffle_read'] / 1e6:9.2f}")


if __name__ == "__main__":
    main()
