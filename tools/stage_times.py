"""The slowest stages of a run, from a Spark event log.

Usage: python tools/stage_times.py <event log file or folder> [top]
Reads the JSON event lines and prints, per stage, its duration, task count
and the job description it ran under (bench.py names each query), slowest
first, then the stage seconds summed per description.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _open(fname: str):
    """A text reader; Spark 4 compresses event logs with zstd by default."""
    if fname.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(fname, "rb"))
        return io.TextIOWrapper(raw, encoding="utf-8", errors="replace")
    return open(fname, encoding="utf-8", errors="replace")


def stages(path: str) -> list[tuple[float, int, int, str]]:
    if os.path.isdir(path):      # an event-log folder (rolling logs are folders too)
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path)
                       for f in names if not f.startswith("."))
    else:
        files = [path]
    out, label = [], {}
    for fname in files:
        with _open(fname) as f:
            for line in f:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                if not isinstance(ev, dict):
                    continue
                if ev.get("Event") == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        label.setdefault(sid, desc)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start is None or end is None:
                    continue
                out.append(((end - start) / 1000.0, info["Stage ID"],
                            info["Number of Tasks"], info["Stage Name"]))
    return sorted(((s, i, n, label.get(i) or name) for s, i, n, name in out), reverse=True)


def main() -> None:
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    rows = stages(sys.argv[1])
    print(f"{len(rows)} stages, {sum(r[0] for r in rows):.1f} s in total")
    for secs, sid, tasks, name in rows[:top]:
        print(f"{secs:8.2f} s  stage {sid:5d}  {tasks:5d} tasks  {name[:70]}")
    per = {}
    for secs, _, _, name in rows:
        per[name] = per.get(name, 0.0) + secs
    print("stage seconds per job description:")
    for name, secs in sorted(per.items(), key=lambda x: -x[1])[:top]:
        print(f"{secs:8.2f} s  {name[:70]}")


if __name__ == "__main__":
    main()
