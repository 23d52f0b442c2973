"""Summarise a Spark event log: the slowest stages with their task count and duration.
usage: python tools/eventlog_stages.py EVENT_LOG_FILE [N]"""

import json
import os
import sys


def _lines(path: str):
    """Event log lines from a file or a rolling event-log directory (plain or zstd parts)."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, n) for n in os.listdir(path) if n.startswith("events_"))
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard
            with open(fp, "rb") as raw:
                text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode()
            yield from text.splitlines()
        else:
            with open(fp) as f:
                yield from f


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    if True:
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                ms = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
                stages.append((ms, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:90]))
    for ms, sid, n, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:7d} ms  stage {sid:5d}  tasks {n:4d}  {name}")
    print(f"stages: {len(stages)}, total stage time: {sum(s[0] for s in stages)} ms")


if __name__ == "__main__":
    main()
