"""Many sheets in one job (batch) and the same via a folder stream."""

import os
import shutil

import pytest

from gridpull.config import ExtractConfig
from gridpull.plans.extract import run, run_batch
from gridpull.sources import part_files, write_csv
from gridpull.streaming import answer_sheet_stream

from test_sheet import S1, _fact, _s1_text, _write

CFG = ExtractConfig(tie_break=("id",))


def _sheets(scratch):
    """Equal base names, blanks in names, no bounds, no hits, own headers."""
    body = _s1_text().splitlines()
    d = os.path.join(scratch, "sheets")
    for sub in ("x", "y"):
        os.makedirs(os.path.join(d, sub))
    shutil.copy(S1, os.path.join(d, "x", "q.csv"))
    _write(d, "y/q.csv", "\n".join(l for l in body if "Date," not in l) + "\n")
    _write(d, "my sheet+1%.csv", "\n".join(["Query sheet"] + body[1:]) + "\n")
    _write(d, "none.csv", ",Header,Voyage ID,id,voyage_id\n,StartDate,2025-01-01\n,Voyage ID,nobody\n")
    _write(d, "zero.csv", ",Header,voyage_expense_desc\n,StartDate\n,Voyage ID,,null\n")
    return d, ["x/q.csv", "y/q.csv", "my sheet+1%.csv", "none.csv", "zero.csv"]


def _batch_files(out):
    from urllib.parse import unquote

    got = {}
    for f in part_files(out):
        key = unquote(os.path.basename(os.path.dirname(f)).removeprefix("sheet="))
        got[key] = got.get(key, b"") + open(f, "rb").read()
    return got


def test_batch_files_equal_single_runs(spark, scratch):
    d, names = _sheets(scratch)
    out = os.path.join(scratch, "batch_out")
    every = [os.path.join(d, n) for n in names]
    done = run_batch(spark, every, _fact(spark), CFG, out_path=out)
    assert done.errors.count() == 0
    got = _batch_files(out)
    assert sorted(got) == sorted(names)
    rows = {r["sheet"]: r["n_rows"] for r in done.rows.collect()}
    for n in names:
        one = os.path.join(scratch, "single.csv")
        res = run(spark, os.path.join(d, n), _fact(spark), CFG, out_path=one)
        assert got[n] == open(one, "rb").read(), n
        assert res.metrics["rows"] == next(v for k, v in rows.items() if k.endswith("/" + n))
    assert got["none.csv"].decode("utf-8-sig") == "voyage_id,id,voyage_id\n"
    done.release()


def test_batch_rows_are_in_order(spark, scratch):
    d, names = _sheets(scratch)
    done = run_batch(spark, os.path.join(d, "x"), _fact(spark), CFG)
    dates = [r.voyage_date_voyagestart for r in done.result.collect()]
    assert dates == sorted([x for x in dates if x]) + [None]


def test_batch_reports_broken_sheets(spark, scratch):
    d, names = _sheets(scratch)
    body = _s1_text().splitlines()
    _write(d, "x/no_label.csv", "\n".join(l for l in body if ",Header," not in l) + "\n")
    _write(d, "x/no_names.csv", "\n".join(",Header,,,,,," if ",Header," in l else l for l in body) + "\n")
    done = run_batch(spark, os.path.join(d, "x"), _fact(spark), CFG)
    said = {os.path.basename(r.sheet): r.error for r in done.errors.collect()}
    assert said == {
        "no_label.csv": "no cell of the label columns reads 'Header'",
        "no_names.csv": "nothing stands right of 'Header'",
    }
    assert {os.path.basename(r.sheet) for r in done.result.select("sheet").distinct().collect()} == {"q.csv"}


def test_batch_honours_bad_bounds(spark, scratch):
    d, names = _sheets(scratch)
    out = os.path.join(scratch, "strict")
    done = run_batch(spark, [os.path.join(d, n) for n in names], _fact(spark), CFG.with_(on_bad_bound="error"), out_path=out)
    bad = {r.sheet.rsplit("sheets/", 1)[1]: r.error for r in done.errors.collect()}
    assert sorted(bad) == ["my sheet+1%.csv", "x/q.csv"] and all("not a date" in e for e in bad.values())
    assert sorted(_batch_files(out)) == ["none.csv", "y/q.csv", "zero.csv"]


def test_folder_stream(spark, scratch):
    d, names = _sheets(scratch)
    _write(d, "x/broken.csv", "a,b\n")
    out = os.path.join(scratch, "out")
    q = answer_sheet_stream(spark, os.path.join(d, "x"), _fact(spark), CFG, out, os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    assert q.exception() is None
    one = os.path.join(scratch, "single.csv")
    run(spark, os.path.join(d, "x", "q.csv"), _fact(spark), CFG, out_path=one)
    assert list(_batch_files(out).values()) == [open(one, "rb").read()]
    errors = spark.read.option("header", "true").csv(out + "_errors/batch=0").collect()
    assert [os.path.basename(r[0]) for r in errors] == ["broken.csv"]


def test_failed_write_keeps_the_old_result(spark, scratch):
    from pyspark.sql import functions as F

    def read(path, single):  # Spark may begin a folder with an empty part
        return "".join(open(f, encoding="utf-8-sig").read() for f in ([path] if single else part_files(path)))

    good = spark.createDataFrame([(1,)], "a int")
    bad = good.select(F.raise_error(F.lit("stop")).cast("string").alias("a"))
    for single in (True, False):
        path = os.path.join(scratch, f"kept-{single}")
        write_csv(good, path, single_file=single)
        with pytest.raises(Exception, match="stop"):
            write_csv(bad, path, single_file=single)
        assert read(path, single) == "a\n1\n"
        write_csv(good.where("false"), path, single_file=single)
        assert read(path, single) == "a\n"
        assert [f for f in os.listdir(scratch) if ".new-" in f or ".old-" in f] == []


def test_repeated_header_names_are_written(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 2.5)], "a int, b double").select(F.col("a").alias("x"), F.col("b").alias("x"), F.lit("").alias("x"))
    path = os.path.join(scratch, "twice.csv")
    write_csv(df, path, single_file=True)
    assert open(path, encoding="utf-8-sig").read() == "x,x,x\n1,2.5,\n"
