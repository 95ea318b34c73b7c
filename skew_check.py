"""Developer check: task balance under a hot key, read from Spark's event log.

Traffic is derived from lineitem with one third of the rows moved to a single source
address.  Each plan below is run to completion; for every stage the event log gives
the shuffle records each task read (scan stages are left out: their split is set by
the file layout, not by keys).  The report shows, per plan, the shuffle stage whose
largest task read the biggest share of that stage's records.

    python skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.functions.sequence import with_previous
from threatlens.operators.alerts import incident_steps
from threatlens.operators.logins import brute_force_bursts, success_after_failures
from threatlens.operators.traffic import TRAFFIC_ORDER, traffic_anomalies
from threatlens.session import build_session
from threatlens.sources import views as V


def hot_traffic(spark, sf_dir):
    t = V.network_traffic(spark, sf_dir)
    hot = F.pmod(F.col("tie_key"), F.lit(3)) == 0
    return t.withColumn("source_ip", F.when(hot, F.lit("10.66.66.66")).otherwise(F.col("source_ip")))


def hot_logins(spark, sf_dir):
    lg = V.login_attempts(spark, sf_dir)
    return lg.withColumn(
        "username", F.when(F.pmod(F.col("attempt_id"), F.lit(3)) == 0, F.lit("admin")).otherwise(F.col("username"))
    )


def hot_alerts(spark, sf_dir):
    a = V.security_alerts(spark, sf_dir)
    hot = F.pmod(F.col("alert_id"), F.lit(3)) == 0
    d = F.col("detection_details")
    return a.withColumn(
        "detection_details",
        F.create_map(
            F.lit("ip_address"), d.getItem("ip_address"),
            F.lit("username"), d.getItem("username"),
            F.lit("incident_id"), F.when(hot, F.lit("INC-HOT")).otherwise(d.getItem("incident_id")),
        ),
    )


def window_steps(a):
    inc = a.withColumn("incident_id", F.col("detection_details").getItem("incident_id"))
    return inc.withColumn(
        "step", F.row_number().over(Window.partitionBy("incident_id").orderBy("timestamp", "alert_id"))
    )


def window_bursts(lg):
    fails = lg.filter(~F.col("success")).withColumn("_sec", F.unix_timestamp("timestamp"))
    w = Window.partitionBy("username").orderBy("_sec", "attempt_id")
    prev = F.lag("_sec").over(w)
    new = F.when(prev.isNull() | (F.col("_sec") - prev > 60), 1).otherwise(0)
    return fails.withColumn("_b", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "username", "_b"
    ).count()


def reference_lag(t):
    w = Window.partitionBy("source_ip").orderBy("timestamp")
    gap = F.unix_timestamp("timestamp") - F.unix_timestamp(F.lag("timestamp").over(w))
    return t.withColumn("rapid_connection", F.coalesce(gap < 1, F.lit(False)))


def reference_look_back(lg):
    w = Window.partitionBy("username").orderBy("timestamp", "attempt_id").rowsBetween(-3, -1)
    return lg.withColumn("recent", F.sum(F.when(~F.col("success"), 1).otherwise(0)).over(w))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="threatlens-eventlog-")
    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.sql.files.maxPartitionBytes": str(1 << 20),
            # keep 16 reducers visible (no coalescing) so balance is measurable
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    sc = spark.sparkContext
    plans = {
        "window per source (reference rapid flag)": lambda: reference_lag(hot_traffic(spark, sf_dir)),
        "threatlens traffic_anomalies": lambda: traffic_anomalies(hot_traffic(spark, sf_dir)),
        "threatlens with_previous (exact lag)": lambda: with_previous(
            hot_traffic(spark, sf_dir), ["source_ip"], list(TRAFFIC_ORDER), "timestamp", "prev"
        ),
        "window per user (look-back 3 rows)": lambda: reference_look_back(hot_logins(spark, sf_dir)),
        "threatlens success_after_failures": lambda: success_after_failures(hot_logins(spark, sf_dir)),
        "window per incident (step numbers)": lambda: window_steps(hot_alerts(spark, sf_dir)),
        "threatlens incident_steps": lambda: incident_steps(hot_alerts(spark, sf_dir)),
        "window per user (burst sessions)": lambda: window_bursts(hot_logins(spark, sf_dir)),
        "threatlens brute_force_bursts": lambda: brute_force_bursts(hot_logins(spark, sf_dir), keys=("username",)),
    }
    for name, build in plans.items():
        sc.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    stage_plan, per_task = {}, defaultdict(list)
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in paths:
        if path.endswith((".zstd", ".lz4", ".snappy", ".gz")):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if desc:
                            stage_plan[sid] = desc
                elif kind == "SparkListenerTaskEnd" and ev.get("Task End Reason", {}).get("Reason") == "Success":
                    m = ev.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    per_task[ev["Stage ID"]].append(rec)
    worst = {}
    for sid, recs in per_task.items():
        plan = stage_plan.get(sid)
        total = sum(recs)
        if plan is None or total < 5000 or len(recs) < 2:
            continue
        share = max(recs) / total
        if plan not in worst or share > worst[plan][0]:
            worst[plan] = (share, sid, len(recs), max(recs), statistics.median(recs), total)
    print(f"{'plan':45s} {'stage':>5s} {'tasks':>5s} {'max task':>9s} {'median':>8s} {'stage total':>11s} {'max share':>9s}")
    for name in plans:
        if name in worst:
            share, sid, n, mx, med, total = worst[name]
            print(f"{name:45s} {sid:5d} {n:5d} {mx:9d} {med:8.0f} {total:11d} {share:9.1%}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
