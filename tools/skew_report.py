"""Rows per task for the predictors and the session finder, plain vs
bucketed, on a hot-tag variant of the events table (event types click, view
and error relabelled to one tag: about 60% of all rows).

Task metrics come from Spark's event log, written to a fresh scratch folder.
For every form, the stage that reads the most shuffled rows (the windowed
row stage) is reported: its number of tasks with rows and the largest number
of rows one task read.

usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from postscope.operators import predict, stats  # noqa: E402
from postscope.operators.slices import PART, SLICE, sliced  # noqa: E402
from postscope.session import get_session  # noqa: E402
from postscope.sources.tables import event_posts, table  # noqa: E402


def read_log(log_dir):
    job_desc, stage_job = {}, {}
    tasks = defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description")
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = desc
                elif ev == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    tasks[e["Stage ID"]].append(m.get("Total Records Read", 0))
    by_desc = defaultdict(list)
    for sid, recs in tasks.items():
        if stage_job.get(sid):
            by_desc[stage_job[sid]].append(recs)
    return by_desc


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="postscope-eventlog-")
    # coalescing off: at this size AQE would merge every shuffle partition into
    # one task and hide how the rows are spread
    spark = get_session("local[8]", shuffle_partitions=64,
                        extra={"spark.sql.adaptive.coalescePartitions.enabled": "false",
                               "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ev = event_posts(table(spark, sf, "events"))
    hot = ev.withColumn("tag", F.when(F.col("tag").isin("click", "view", "error"), F.lit("hot"))
                        .otherwise(F.col("tag")))
    order = ["t", "id"]
    at = lambda df: sliced(df, "tag", order)
    # the same rows within one five-second micro-batch
    burst = hot.withColumn("t", F.timestamp_micros(F.lit(1_600_000_000_000_000) + F.pmod("id", F.lit(5_000_000))))
    cases = {
        "ewma plain": predict.ewma_predict(hot, "tag", order, "followersCount", keep=["id"]),
        "ewma sliced": predict.ewma_predict(at(hot), "tag", order, "followersCount", bucket=SLICE, keep=["id"]),
        "ewma sliced, all rows within 5 s": predict.ewma_predict(at(burst), "tag", order, "followersCount", bucket=SLICE, keep=["id"]),
        "sma plain": predict.sma_predict(hot, "tag", order, "followersCount", keep=["id"]),
        "sma sliced": predict.sma_predict(at(hot), "tag", order, "followersCount", bucket=SLICE, keep=["id"]),
        "regression plain": predict.regression_predict(hot, "tag", order, "statusesCount", "followersCount", keep=["id"]),
        "regression sliced": predict.regression_predict(at(hot), "tag", order, "statusesCount", "followersCount",
                                                        bucket=SLICE, keep=["id"]),
        "sessions session_window": stats.windowed_stats(hot, "t", session_gap="10 minutes"),
        "sessions sliced": stats.windowed_stats(sliced(hot, "tag", ["t"]), "t", session_gap="10 minutes", session_bucket=F.col(SLICE)),
    }
    rows = at(hot)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    load = sorted(r["count"] for r in rows.groupBy(F.pmod(F.hash(PART), F.lit(buckets)).alias("b")).count().collect())
    for name, df in cases.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    by_desc = read_log(log_dir)
    print(f"hot-tag events at {os.path.basename(sf)}, 64 shuffle partitions, AQE partition coalescing off;")
    print("per form, the stage reading the most shuffled rows\n")
    print("| form | tasks with rows | max rows read by one task | rows read in the stage |")
    print("| --- | --- | --- | --- |")
    for name in cases:
        stages = by_desc.get(name, [])
        if not stages:
            continue
        big = max(stages, key=sum)
        print(f"| {name} | {sum(1 for r in big if r)} | {max(big)} | {sum(big)} |")
    print(f"\nSliced forms shuffle slice summaries only. Their rows are read from a slice table, one bucket a task: {len(load)} tasks with rows, "
          f"{sum(load) // buckets} on average, {load[-1]} at most, of {sum(load)}.")


if __name__ == "__main__":
    main()
