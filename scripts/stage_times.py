"""Per-job timing of one pipeline run, from Spark's event log.

Usage: python scripts/stage_times.py [sf_dir]   (default /root/testdata/sf0.1)
Runs bronze -> silver -> gold once (after a small warm-up) with the event log
written to a fresh scratch directory, then prints, per Spark job of the
measured run: start offset, duration, call site and (duration, tasks) of its
stages.  Single-task stages and long gaps between jobs show up directly.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(log_dir: str):
    files = sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)) or sorted(
        glob.glob(os.path.join(log_dir, "*"))
    )
    for path in files:
        if os.path.isdir(path):
            continue
        with open(path, "rb") as fh:
            if path.endswith(".zstd"):
                import zstandard

                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from haulage.plans.pipeline import Pipeline
    from haulage.session import build_session
    from haulage.sources.testdata import source_frames

    log_dir = tempfile.mkdtemp(prefix="haulage-events-")
    out = tempfile.mkdtemp(prefix="haulage-stages-")
    spark = build_session(
        "local[8]", shuffle_partitions=8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    )
    Pipeline(spark, source_frames(spark, "/root/testdata/sf0.001"), out + "/warm", gold_csv=False).run("all")
    spark.sparkContext.setJobDescription("MEASURED")
    audit = Pipeline(spark, source_frames(spark, sf), out + "/run").run(["bronze", "silver", "gold"])
    spark.stop()
    jobs, stages = {}, {}
    for e in read_events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            props = e.get("Properties", {})
            jobs[e["Job ID"]] = {
                "start": e["Submission Time"],
                "desc": props.get("spark.job.description", ""),
                "stages": e["Stage IDs"],
                "site": props.get("callSite.short", ""),
            }
        elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (
                (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000,
                info["Number of Tasks"],
            )
    measured = [(k, v) for k, v in sorted(jobs.items()) if v["desc"] == "MEASURED"]
    if not measured:
        print("no measured jobs found in", log_dir)
        return
    t0 = measured[0][1]["start"]
    print("steps:", [(a.step, round(a.seconds, 2)) for a in audit])
    for jid, j in measured:
        st = [(round(stages[s][0], 2), stages[s][1]) for s in j["stages"] if s in stages]
        dur = (j.get("end", j["start"]) - j["start"]) / 1000
        print(f"job {jid:4d} +{(j['start'] - t0) / 1000:6.2f}s {dur:5.2f}s {j['site'][:48]:48s} {st}")


if __name__ == "__main__":
    main()
