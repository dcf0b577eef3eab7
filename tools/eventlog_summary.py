"""Summarise a Spark event log folder: slowest jobs and stages.

usage: python tools/eventlog_summary.py <eventlog dir or file>"""
import glob
import json
import os
import sys


def main(path):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True))
    stages, jobs, jstart = {}, {}, {}
    for f in files:
        if os.path.isdir(f):
            continue
        if f.endswith(".zstd"):
            import io
            import zstandard
            lines = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
        else:
            lines = open(f, encoding="utf-8", errors="replace")
        for line in lines:
            try:
                e = json.loads(line)
            except ValueError:
                continue
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[si["Stage ID"]] = (round(dur, 2), si["Number of Tasks"], si["Stage Name"][:70])
            elif ev == "SparkListenerJobStart":
                jstart[e["Job ID"]] = e["Submission Time"]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]] = round((e["Completion Time"] - jstart.get(e["Job ID"], e["Completion Time"])) / 1000, 2)
    print("jobs:", len(jobs), "total job time:", round(sum(jobs.values()), 2))
    print("slowest jobs:", sorted(jobs.items(), key=lambda x: -x[1])[:10])
    for k, v in sorted(stages.items(), key=lambda x: -x[1][0])[:15]:
        print("stage", k, v)


if __name__ == "__main__":
    main(sys.argv[1])
