"""Command line: answer one parameter sheet (or a folder of sheets) against
a fact table and write the CSV result.

    python -m gridpull --sheet sheets/query_params.csv \\
        --parquet /data/summary --out out/db_results [--id-col voyage_id] \\
        [--date-col voyage_date_voyagestart] [--tie-break id] [--date-only]
        [--where "col=value,col~pattern"]...

``--table schema.table`` reads a catalog table instead of Parquet. ``--where``
is a filter group: its conditions (``=`` or ``~`` for LIKE) must all hold; of
several groups one must. Dates are read and written in UTC. Other session
settings come from the environment (spark-defaults, PYSPARK_SUBMIT_ARGS).
A single sheet gives one CSV file (``--parts``: a folder of parts), ``--batch``
a folder per sheet beside ``<out>_errors`` with every sheet that has no answer.
"""

from __future__ import annotations

import argparse
import json
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import DEFAULT_DATE_COL, DEFAULT_ID_COL, ExtractConfig
from .plans.extract import SINGLE_FILE_ROWS, run, run_batch
from .sources.csv_sink import write_csv
from .sources.fact import read_parquet, read_table


def filter_group(text: str) -> list[tuple[str, str, str]]:
    """``a=x,b~y%`` -> [(a, =, x), (b, like, y%)]; a backslash keeps a comma."""
    out = []
    for part in re.split(r"(?<!\\),", text):
        m = re.fullmatch(r"\s*([^=~]+?)\s*([=~])(.*)", part.replace("\\,", ","), re.S)
        if m is None:
            raise argparse.ArgumentTypeError(f"no condition: {part!r}")
        out.append((m[1], "like" if m[2] == "~" else "=", m[3]))
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="gridpull")
    ap.add_argument("--sheet", required=True, help="sheet CSV file, or a folder of sheets with --batch")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet", help="fact table as Parquet path")
    src.add_argument("--table", help="fact table as catalog name (schema.table)")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--id-col", default=DEFAULT_ID_COL)
    ap.add_argument("--date-col", default=DEFAULT_DATE_COL)
    ap.add_argument("--tie-break", default="", help="comma-separated survivor order (a primary key)")
    ap.add_argument("--date-only", action="store_true")
    ap.add_argument("--on-bad-bound", choices=("open", "error"), default="open")
    ap.add_argument("--batch", action="store_true", help="many sheets in one job, output partitioned by sheet")
    ap.add_argument("--where", action="append", type=filter_group, default=[], help="filter group, may repeat")
    ap.add_argument("--parts", action="store_true", help="write a folder of parts instead of one file")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("gridpull").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    fact = read_parquet(spark, a.parquet) if a.parquet else read_table(spark, a.table)
    cfg = ExtractConfig(
        id_col=a.id_col,
        date_col=a.date_col,
        tie_break=tuple(c for c in a.tie_break.split(",") if c),
        date_only=a.date_only,
        on_bad_bound=a.on_bad_bound,
    )
    if a.batch:
        done = run_batch(spark, a.sheet, fact, cfg, out_path=a.out, where=a.where)
        errors = write_csv(done.errors, a.out.rstrip("/") + "_errors")
        n = done.rows.agg(F.count("*").alias("sheets"), F.sum("n_rows").alias("rows")).first()
        print(json.dumps({"out": a.out, "sheets": n["sheets"], "rows": n["rows"] or 0, "errors": done.errors.count(), "errors_out": errors}))
        done.release()
        return 0
    res = run(spark, a.sheet, fact, cfg, out_path=a.out, single_file=False if a.parts else SINGLE_FILE_ROWS, where=a.where)
    print(json.dumps({"out": res.output, "header": res.plan.header, **res.metrics}))
    res.release()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
