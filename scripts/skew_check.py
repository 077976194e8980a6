"""Skew check for the large-set path.

Builds a skewed view of lineitem (one supplier id holds a third of all rows)
and a set table where the same id holds a third of 3,000 sets, then runs

* the bucketed set join (what ``param_match`` uses beyond the broadcast
  bound), and
* a plain sort-merge semi join on id with the range as residual, and
* the bucketed join with narrow ranges only (one month, all of the hot id),
  whose rows outside all ranges must not pile up anywhere,

with broadcasts disabled, and reports wall time and, from the event log,
the largest and median task in each job (records read).

    python scripts/skew_check.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import random
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else "/tmp/skew"
    import zstandard
    from pyspark.sql import functions as F

    from gridpull.config import ExtractConfig
    from gridpull.operators.joins import bucketed_range_join, merge_ranges_balanced, param_match, prepared_sets, range_ok
    from gridpull.operators.sizing import materialize
    from gridpull.plans.catalog import literal_params
    from gridpull.session import local_session

    logdir = os.path.join(scratch, f"events-{int(time.time())}")
    os.makedirs(logdir)
    spark = local_session(8, "skew-check", {
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
    })
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    # a third of all rows move to supplier 3
    fact = li.withColumn("l_suppkey", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(3)).otherwise(F.col("l_suppkey")))
    rnd = random.Random(3)
    sets = []
    for i in range(3000):
        sid = "3" if i % 3 == 0 else str(rnd.randint(0, 99))
        d0 = rnd.randint(0, 2400)
        start = (time.strftime("%Y-%m-%d", time.gmtime(788918400 + d0 * 86400))) + " 00:00:00"
        end = (time.strftime("%Y-%m-%d", time.gmtime(788918400 + (d0 + rnd.randint(0, 3)) * 86400))) + " 23:59:59"
        sets.append((sid, start, end))
    params = literal_params(spark, tuple(sets))
    cfg = ExtractConfig(id_col="l_suppkey", date_col="l_shipdate")
    typed = prepared_sets(fact, params, cfg).select("_pid", "_ps", "_pe").distinct()

    out = {}
    t0 = time.time()
    spark.sparkContext.setJobGroup("bucketed", "bucketed")
    merged = materialize(merge_ranges_balanced(typed, ["_pid"], partitions=32))
    n_b = bucketed_range_join(fact, merged, cfg).count()
    out["bucketed"] = {"rows": n_b, "sec": round(time.time() - t0, 2)}

    t0 = time.time()
    spark.sparkContext.setJobGroup("plain_smj", "plain_smj")
    raw = materialize(typed)
    f, s = fact.alias("f"), raw.alias("s")
    cond = (F.col("f.l_suppkey") == F.col("s._pid")) & range_ok(F.col("f.l_shipdate"), F.col("s._ps"), F.col("s._pe"))
    n_p = f.join(s, cond, "left_semi").count()
    out["plain_smj"] = {"rows": n_p, "sec": round(time.time() - t0, 2)}
    t0 = time.time()
    spark.sparkContext.setJobGroup("narrow", "narrow")
    days = [(f"1997-12-{1 + i % 28:02d} {i % 24:02d}:00:00", f"1997-12-{1 + i % 28:02d} {i % 24:02d}:30:00") for i in range(100)]
    few = materialize(prepared_sets(fact, literal_params(spark, tuple(("3", a, b) for a, b in days)), cfg).select("_pid", "_ps", "_pe").distinct())
    n_n = param_match(fact, literal_params(spark, tuple(("3", a, b) for a, b in days)), cfg.with_(hot_id_sets=10), strategy="shuffle").count()
    out["narrow"] = {"rows": n_n, "sets": few.count(), "sec": round(time.time() - t0, 2)}
    spark.stop()

    # largest / median task per job group, by records read
    tasks = {}
    groups = {}
    for path in glob.glob(os.path.join(logdir, "*", "events*")) + glob.glob(os.path.join(logdir, "*")):
        if os.path.isdir(path):
            continue
        with open(path, "rb") as fh:
            text = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True).read().decode("utf-8", "ignore")
        for line in text.splitlines():
            try:
                e = json.loads(line)
            except Exception:
                continue
            if e.get("Event") == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    groups[sid] = g
            if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                m = e["Task Metrics"]
                recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                tasks.setdefault(e["Stage ID"], []).append((recs, e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"]))
    for sid, ts in tasks.items():
        g = groups.get(sid)
        if g not in out or len(ts) < 4:
            continue
        recs = [r for r, _ in ts]
        if max(recs) == 0:
            continue
        cur = out[g].setdefault("worst_stage", {"max_records": 0})
        if max(recs) > cur["max_records"]:
            out[g]["worst_stage"] = {
                "stage": sid, "tasks": len(ts), "max_records": max(recs), "median_records": int(statistics.median(recs)),
                "max_task_ms": max(d for _, d in ts), "median_task_ms": int(statistics.median([d for _, d in ts])),
            }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
