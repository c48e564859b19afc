"""Skew probe: one user holds a third of all events.

Runs the login-pattern detector two ways -- through ``segmented_scan`` (the
library) and as a plain ``lead()`` window over the whole user -- and the
late-data split (a running max in arrival order, no key at all) both ways, and
reports, from Spark's event log, the largest and the mean number of shuffle records
that a task of the widest stage read.  The hot user (or, without a key, the whole table)
lands in one task with a plain window; the segmented scan spreads it over chunks
(of 500 rows here, since the table is small).

usage: python tools/skew_probe.py [sf_dir]   (event log goes to a fresh /tmp folder)
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_records(log_dir: str) -> str:
    """Largest and mean records read by a task, of the stage that read the most."""
    stages: dict[tuple, list[int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                rd = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                stages.setdefault((path, ev["Stage ID"]), []).append(rd.get("Total Records Read", 0))
    most = max(stages.values(), key=sum)
    return f"{max(most)} (mean {sum(most) / len(most):.0f} over {len(most)} tasks)"


def run(sf_dir: str, variant: str) -> int:
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from tidemark.operators import login_fail_pattern
    from tidemark.sources import tables as T

    log_dir = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName(f"skew-{variant}")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("tidemark.scan.chunkRows", "500")
             .getOrCreate())
    ev = T.events(spark, sf_dir)
    # every third event belongs to one hot user
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    logins = T.logins(hot)
    if variant in ("late_segmented", "late_window"):
        from tidemark.operators import split_late

        arr = T.with_arrival(ev)
        if variant == "late_segmented":
            out = split_late(arr, F.col("arrival_us"), "ts", "event_id", 3600, None, 64, 60).filter("is_late")
        else:   # running max over one global order: every row in one task
            w = Window.orderBy("arrival_us", "event_id").rowsBetween(Window.unboundedPreceding, -1)
            mx = F.max(F.unix_micros("ts")).over(w) - F.lit(64_000_000)
            end = (F.floor(F.unix_micros("ts") / 3_600_000_000) + 1) * 3_600_000_000
            out = arr.withColumn("__wm", mx).filter(end + F.lit(60_000_000) <= F.col("__wm"))
    elif variant == "segmented":
        out = login_fail_pattern(logins, 6 * 3600)
    else:
        w = Window.partitionBy("user_id").orderBy("ts", "event_id")
        out = (logins.withColumn("__n_ts", F.lead("ts").over(w))
               .withColumn("__n_type", F.lead("event_type").over(w))
               .filter((F.col("event_type") == "fail") & (F.col("__n_type") == "fail")
                       & (F.col("__n_ts") < F.col("ts") + F.expr("INTERVAL 6 HOURS"))))
    n = out.count()
    spark.stop()
    print(f"{variant:10s} rows={n} task_shuffle_records={task_records(log_dir)} "
          f"hot_user_logins={logins_count(sf_dir)}", flush=True)
    return n


def logins_count(sf_dir: str) -> str:
    import duckdb

    q = (f"SELECT count(*) FROM read_parquet('{sf_dir}/events.parquet') "
         "WHERE event_id % 3 = 0 AND event_type IN ('error', 'signup')")
    return str(duckdb.sql(q).fetchall()[0][0])


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    a, b = run(sf, "segmented"), run(sf, "window")
    assert a == b, (a, b)
    c, d = run(sf, "late_segmented"), run(sf, "late_window")
    assert c == d, (c, d)
