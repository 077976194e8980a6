"""Benchmark the headline queries plus one whole sheet run.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: total seconds over the headline queries plus one
number per query. Every query is built and then fully executed with the
``noop`` sink (no driver collection); each is run three times after a warm-up
query, the median is reported and all three are listed under ``runs``.
``sheet_run_csv`` times a whole run like the logged ones of the original
workflow: a three-set sheet file read, answered against lineitem, written
as CSV.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "param_extract",
    "param_extract_shuffle",
    "many_sets",
    "dedup_id_date",
    "sheet_extract",
    "param_join",
    "set_counts",
    "page_n",
    "sort_date_id",
    "param_extract_hot_id",
    "sheet_filter_groups",
)


# A three-set sheet like the logged runs of the original workflow (three sets,
# a dozen output columns), answered against lineitem end to end.
SHEET_TEXT = (
    "Query sheet,,,,\n"
    ",Header,l_shipdate,l_suppkey,l_orderkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,rate usd\n"
    ",StartDate,1996-01-01 00:00,7/1/1996,\n"
    ",EndDate,1996-12-31,1997-03-31 23:59:59,1995-12-31\n"
    ",Voyage ID,3,3,7\n"
)


def sheet_run(spark, sf_dir: str, scratch: str) -> float:
    """Sheet file -> sets -> semi join -> dedup -> sort -> CSV, timed."""
    from gridpull.config import ExtractConfig
    from gridpull.plans.extract import run

    sheet = os.path.join(scratch, "sheet.csv")
    with open(sheet, "w", encoding="utf-8") as fh:
        fh.write(SHEET_TEXT)
    cfg = ExtractConfig(id_col="l_suppkey", date_col="l_shipdate")
    fact = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    t0 = time.perf_counter()
    done = run(spark, sheet, fact, cfg, out_path=os.path.join(scratch, f"out-{time.time_ns()}.csv"))
    took = time.perf_counter() - t0
    done.release()
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from gridpull.plans.catalog import REGISTRY
    from gridpull.plans.catalog_more import MORE
    from gridpull.session import local_session

    spark = local_session(cpus, "gridpull-bench", {"spark.sql.shuffle.partitions": str(max(int(cpus), 1) * 2)})
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    runs: dict[str, list[float]] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        fn = (REGISTRY | MORE)[name][0]
        runs[name] = []
        for _ in range(3):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs[name].append(round(time.perf_counter() - t0, 3))
        times[name] = median(runs[name])
        rows[name] = fn(spark, sf_dir).count()
    import tempfile

    scratch = tempfile.mkdtemp(prefix="gridpull-bench-")
    runs["sheet_run_csv"] = [round(sheet_run(spark, sf_dir, scratch), 3) for _ in range(3)]
    times["sheet_run_csv"] = median(runs["sheet_run_csv"])
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "runs": runs,
        "rows": rows,
        "sf": sf,
        "cpus": int(cpus),
        "spark": {
            "master": spark.sparkContext.master,
            "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
        },
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
