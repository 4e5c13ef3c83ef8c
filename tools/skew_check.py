"""Measure task balance under a hot key, from Spark's event log.

Derives a skewed copy of the ``events`` table in memory (a third of the rows
moved to user 0), then runs "next event of the same user" twice: as a plain
``lead`` over a window per user, and with ``next_in_key`` (hot keys cut into
segments).  For each run it reports the largest and the median number of
shuffle records read by one task in the busiest stage.

Usage: python tools/skew_check.py [sf_dir] [cell]
The event log goes to a fresh scratch folder (``mktemp -d``); nothing else is written.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def stage_records(log_dir: str, job_group: str) -> list[tuple[int, list[int]]]:
    """Per stage of the jobs in ``job_group``: shuffle records read by each task."""
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**"), recursive=True) if os.path.isfile(p))
    stages_of_group, per_stage = set(), {}
    for path in paths:
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                if props.get("spark.jobGroup.id") == job_group:
                    stages_of_group.update(ev.get("Stage IDs", []))
            elif kind == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                per_stage.setdefault(ev["Stage ID"], []).append(recs)
    return [(s, r) for s, r in sorted(per_stage.items()) if s in stages_of_group and sum(r) > 0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cell = int(sys.argv[2]) if len(sys.argv) > 2 else 200
    log_dir = tempfile.mkdtemp(prefix="wardline-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep 8 tasks visible
        .config("spark.ui.enabled", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")  # both sides large, as at scale
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from wardline.operators.relate import next_in_key
    from wardline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    hot_share = skewed.filter("user_id = 0").count() / skewed.count()

    sc = spark.sparkContext
    sc.setJobGroup("plain", "window per user")
    plain = skewed.withColumn("nxt", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    plain.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("segmented", "next_in_key")
    seg = next_in_key(skewed, "user_id", "ts", "event_id", "nxt")
    seg.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("check", "compare results")
    same = plain.select("event_id", "nxt").exceptAll(seg.select("event_id", "nxt")).isEmpty()

    # interval join: errors of a user with that user's purchases/signups in the next 24 hours
    full = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    full = full.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    visits = full.filter("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("at"))
    stays = full.filter("event_type IN ('purchase', 'signup')").select(
        F.col("user_id").alias("su"), F.col("ts").alias("st"))
    sc.setJobGroup("plain_join", "equi-join on user + range")
    cond = (visits.user_id == stays.su) & (stays.st >= visits.at) & (stays.st <= visits.at + F.expr("INTERVAL 24 HOURS"))
    pj = visits.join(stays, cond, "left")
    pj.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("segmented_join", "interval_join")
    from wardline.operators.joins import interval_join

    sj = interval_join(visits, stays, keys=[("user_id", "su")], left_ts="at", right_ts="st", hours=24, cell=cell)
    sj.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("check", "compare results")
    same_join = pj.exceptAll(sj.select(*pj.columns)).isEmpty() and sj.select(*pj.columns).exceptAll(pj).isEmpty()
    spark.stop()

    report = {"hot_key_share": round(hot_share, 3), "cell": cell, "same_result": same and same_join}
    for group in ("plain", "segmented", "plain_join", "segmented_join"):
        stages = stage_records(log_dir, group)
        s, recs = max(stages, key=lambda x: (sum(x[1]), max(x[1])))  # the stage that reads every row
        report[group] = {"busiest_stage_tasks": len(recs), "max_task_records": max(recs),
                         "median_task_records": int(statistics.median(recs))}
        if os.environ.get("SKEW_VERBOSE"):
            report[group]["stages"] = [(st, len(r), max(r), sum(r)) for st, r in stages]
    print(json.dumps(report))


if __name__ == "__main__":
    main()
