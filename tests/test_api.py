"""Smaller API surface: config switches, key fallbacks, sources."""

import os

import pytest
from pyspark.sql import functions as F

from gridpull.config import ExtractConfig, Labels
from gridpull.operators import dedup_keys, sort_result
from gridpull.plans.extract import SheetError, plan_sheet
from gridpull.sources import read_sheet_cells, read_table, set_predicates_sql

from test_sheet import S1, _write


def test_bad_bound_error(spark):
    with pytest.raises(SheetError, match="unreadable date bounds"):
        plan_sheet(read_sheet_cells(spark, S1), ExtractConfig(on_bad_bound="error"))


def test_custom_labels(spark, scratch):
    text = "t\n,Columns,a,b\n,From,2024-01-01\n,To,2024-02-01\n,Key,k1,k2\n"
    p = _write(scratch, "lab.csv", text)
    labels = Labels(header="Columns", start="From", end="To", id="Key", anchors=("Columns", "From"))
    plan = plan_sheet(read_sheet_cells(spark, p), ExtractConfig(labels=labels))
    assert plan.header == ["a", "b"]
    assert sorted(r.id for r in plan.params.collect()) == ["k1", "k2"]


def test_sheet_with_bom_and_quoted_newline(spark, scratch):
    text = "\ufeffHeader,x,\"multi\nline\"\nVoyage ID,a\n"
    p = _write(scratch, "bom.csv", text)
    cells = read_sheet_cells(spark, p)
    plan = plan_sheet(cells, ExtractConfig(labels=Labels(anchors=("Header",))))
    assert plan.header == ["x", "multi_line"]
    assert [r.id for r in plan.params.collect()] == ["a"]


def test_dedup_key_fallbacks(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, "b", 1)], "k int, voyage_id string, x int")
    by_id = dedup_keys(df, "voyage_id", "voyage_date_voyagestart", ["x"])
    assert sorted((r.voyage_id, r.x) for r in by_id.collect()) == [("a", 3), ("b", 1)]
    rows = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert dedup_keys(rows, "voyage_id", None).count() == 2
    assert sort_result(rows, None, None).count() == 3  # no date column: no sort


def test_read_table_and_jdbc_predicates(spark):
    spark.range(3).createOrReplaceTempView("gp_tmp_view")
    assert read_table(spark, "gp_tmp_view").count() == 3
    preds = set_predicates_sql(
        [{"id": "x'y", "start": "2025-01-01T00:00:00", "end": None}, {"id": "z", "start": None, "end": None}],
        "voyage_id",
        "voyage_date_voyagestart",
    )
    assert preds == [
        "\"voyage_id\" = 'x''y' AND \"voyage_date_voyagestart\" >= '2025-01-01T00:00:00'",
        "\"voyage_id\" = 'z'",
    ]


def test_clustered_and_bucketed_layouts(spark, scratch):
    import io
    import contextlib

    from gridpull.plans.catalog import LINEITEM_CFG, LINEITEM_HEADER, literal_params
    from gridpull.plans.extract import extract_rows
    from gridpull.sources.layout import save_bucketed, write_clustered

    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    want = sorted((tuple(r) for r in extract_rows(li, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER).collect()), key=repr)

    path = write_clustered(li, os.path.join(scratch, "li_clustered"), "l_suppkey", "l_shipdate", files=8)
    cl = spark.read.parquet(path)
    got = sorted((tuple(r) for r in extract_rows(cl, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER).collect()), key=repr)
    assert got == want

    spark.conf.set("spark.sql.sources.bucketing.enabled", "true")
    # keep the scan bucketed so the plan reports the pruned bucket count
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gp_layout LOCATION '{scratch}/wh'")
    save_bucketed(li, "gp_layout.li_b", "l_suppkey", "l_shipdate", 16)
    bt = spark.table("gp_layout.li_b")
    q = extract_rows(bt, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER)
    assert sorted((tuple(r) for r in q.collect()), key=repr) == want
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        bt.where("l_suppkey IN (3, 7, 12)").explain("formatted")
    assert "SelectedBucketsCount: 3 out of 16" in buf.getvalue()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


@pytest.mark.parametrize("width", [300, 5000])
def test_wide_sheets_lose_nothing(spark, scratch, width):
    """Blanks at any place, quoted commas and newlines: every id is answered."""
    ids = ["" if i % 7 == 3 else f"k{i}" for i in range(width)]
    notes = ['"a, ""b"",\nc"' if i % 50 == 0 else "" for i in range(width)]
    text = "title\n,Header,voyage_id\n,StartDate,\n,note," + ",".join(notes) + "\n,Voyage ID," + ",".join(ids) + "\n"
    plan = plan_sheet(read_sheet_cells(spark, _write(scratch, "wide.csv", text)), ExtractConfig())
    assert sorted(r.id for r in plan.params.collect()) == sorted(i for i in ids if i)


def test_last_column_blank_before_a_longer_row(spark, scratch):
    cells = ["A"] + [""] * 252 + ["", "B"]
    text = ",Header,x\n,StartDate\n,Voyage ID," + ",".join(cells) + "\n"
    plan = plan_sheet(read_sheet_cells(spark, _write(scratch, "gap.csv", text)), ExtractConfig())
    assert sorted(r.id for r in plan.params.collect()) == ["A", "B"]


def test_summary_schema_end_to_end(spark, scratch):
    import datetime as dt
    import decimal

    from gridpull.config import SUMMARY_TABLE_DDL
    from gridpull.plans.extract import run

    D = decimal.Decimal
    T = dt.datetime
    names = [f.split()[0] for f in SUMMARY_TABLE_DDL.split(", ")]
    base = {n: None for n in names}
    rows = []
    for i, (vid, d, rate) in enumerate(
        [
            ("250101/AAA/BBB", T(2025, 7, 3), D("1234.50")),
            ("250101/AAA/BBB", T(2025, 7, 3), D("9.99")),  # same key: id 1 survives
            ("250202/CCC DDD", T(2025, 8, 17, 12), D("12.00")),
            ("250303/EEE", None, None),
        ]
    ):
        r = dict(base, id=i + 1, voyage_id=vid, voyage_date_voyagestart=d, voyage_rate_usd_24hrgross=rate)
        rows.append(tuple(r[n] for n in names))
    fact = spark.createDataFrame(rows, SUMMARY_TABLE_DDL)
    sheet = _write(
        scratch,
        "summary.csv",
        ",Header,Voyage_Date VoyageStart,voyage_id,Voyage Rate USD 24HRGross,unknown col\n"
        ",StartDate,7/1/2025\n,EndDate,2025-12-31\n,Voyage ID,250101/AAA/BBB,250202/CCC DDD,250303/EEE\n",
    )
    out = os.path.join(scratch, "summary_out.csv")
    res = run(spark, sheet, fact, ExtractConfig(tie_break=("id",)), out_path=out)
    assert res.plan.header == ["voyage_date_voyagestart", "voyage_id", "voyage_rate_usd_24hrgross", "unknown_col"]
    text = open(out, encoding="utf-8-sig").read()
    assert text == (
        "voyage_date_voyagestart,voyage_id,voyage_rate_usd_24hrgross,unknown_col\n"
        "2025-07-03T00:00:00,250101/AAA/BBB,1234.5,\n"
        "2025-08-17T12:00:00,250202/CCC DDD,12.0,\n"
        ",250303/EEE,,\n"  # open set: the NULL-date row matches and sorts last
    )


def test_missing_config_columns_are_reported(spark):
    from gridpull.plans.extract import extract_rows
    from gridpull.plans.catalog import literal_params

    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    with pytest.raises(ValueError, match="lacks configured column"):
        extract_rows(o, literal_params(spark), ExtractConfig(id_col="o_custkey", date_col="nope"), ["o_orderkey"])


def test_non_ascii_sheet_goes_through_nfkc(spark, scratch):
    p = _write(scratch, "wide_chars.csv", ",Header,Ｒａｔｅ USD,voyage_id\n,StartDate,2025-01-01\n,Voyage ID,ＡＢ１,' x  y '\n")
    plan = plan_sheet(read_sheet_cells(spark, p), ExtractConfig())
    assert plan.header == ["rate_usd", "voyage_id"]
    assert sorted(r.id for r in plan.params.collect()) == [" x y ", "AB1"]  # blanks inside quotes stay


def test_sheet_without_labels_is_reported(spark, scratch):
    from gridpull.plans.extract import plan_sheets

    d = os.path.join(scratch, "two")
    os.makedirs(d)
    _write(d, "ok.csv", ",Header,a\n,StartDate,2025-01-01\n,Voyage ID,k\n")
    _write(d, "plain.csv", "just,some,numbers\n1,2,3\n")
    mk, names, params, errs = plan_sheets(read_sheet_cells(spark, d), ExtractConfig())
    assert [(os.path.basename(r.sheet), r.error) for r in errs.collect()] == [("plain.csv", "no cell of the label columns reads 'Header'")]
    assert [r.id for r in params.collect()] == ["k"]


@pytest.mark.parametrize("strategy", ["literal", "broadcast", "shuffle"])
@pytest.mark.parametrize("by", [(), ("sheet",)])
def test_column_names_match_without_case(spark, strategy, by):
    from gridpull.plans.catalog import LINEITEM_CFG, LINEITEM_HEADER, literal_params
    from gridpull.plans.extract import extract_rows

    if by and strategy == "literal":
        pytest.skip("literals have no group")
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    want = [tuple(r) for r in extract_rows(li, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER, by, strategy).collect()]
    upper = li.toDF(*[c.upper() for c in li.columns])
    assert [tuple(r) for r in extract_rows(upper, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER, by, strategy).collect()] == want
    assert len(want) == len({(r[len(by)], r[len(by) + 1]) for r in want})


def test_filter_groups_in_a_run(spark, scratch):
    from gridpull.plans.extract import run
    from test_sheet import _fact

    where = [[("voyage_expense_desc", "=", "a")], [("voyage_expense_desc", "like", "say%"), ("id", "=", 7)]]
    out = os.path.join(scratch, "filtered.csv")
    res = run(spark, S1, _fact(spark), ExtractConfig(tie_break=("id",)), out_path=out, where=where)
    assert res.metrics["rows"] == 2 and sorted(r.voyage_expense_desc for r in res.result.collect()) == ["a", 'say "hi", ok']


def test_command_line(spark, scratch, capsys):
    import json

    from gridpull.__main__ import filter_group, main
    from test_sheet import _fact

    assert filter_group("a = x\\,y,b~z%") == [("a", "=", " x,y"), ("b", "like", "z%")]
    fact = os.path.join(scratch, "fact")
    _fact(spark).write.parquet(fact)
    sheets = os.path.join(scratch, "many")
    os.makedirs(sheets)
    for i in range(120):  # more broken sheets than any report would cut
        _write(sheets, f"broken{i}.csv", "a,b\n")
    _write(sheets, "good.csv", open(S1, encoding="utf-8").read())
    out = os.path.join(scratch, "out")
    assert main(["--sheet", sheets, "--parquet", fact, "--out", out, "--batch", "--tie-break", "id"]) == 0
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (said["sheets"], said["rows"], said["errors"]) == (1, 6, 120)
    assert spark.read.option("header", "true").csv(said["errors_out"]).count() == 120


def test_jdbc_sets_share_queries():
    from gridpull.sources.fact import grouped_predicates

    assert grouped_predicates([], 3) == ["1 = 0"]
    got = grouped_predicates([f"x = {i}" for i in range(7)], 3)
    assert len(got) == 3 and sorted(p for g in got for p in g.split(" OR ")) == sorted(f"(x = {i})" for i in range(7))


def test_workers_need_no_package(scratch):
    """A session whose workers cannot import this package still cleans
    non-ASCII sheets."""
    import subprocess
    import sys

    from conftest import ROOT

    sheet = _write(scratch, "wide_chars.csv", ",Header,\uff32\uff41\uff54\uff45 USD\n,StartDate,2025-01-01\n,Voyage ID,\uff21\uff22\uff11\n")
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from gridpull.session import local_session
from gridpull.config import ExtractConfig
from gridpull.plans.extract import plan_sheet
from gridpull.sources import read_sheet_cells
spark = local_session(1, extra={{"spark.driver.memory": "1g"}})
p = plan_sheet(read_sheet_cells(spark, {sheet!r}), ExtractConfig())
print("GOT", p.header, [r.id for r in p.params.collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=scratch, env=env, capture_output=True, text=True, timeout=300)
    assert "GOT ['rate_usd'] ['AB1']" in done.stdout, done.stderr[-2000:]


def test_tables_go_with_release(spark, scratch):
    from gridpull.plans.extract import run
    from test_sheet import _fact

    res = run(spark, S1, _fact(spark), ExtractConfig(tie_break=("id",), pushdown_max_sets=0), out_path=os.path.join(scratch, "o.csv"))
    paths = [p.removeprefix("file:") for p in res.tables]
    assert paths and all(os.path.isdir(p) for p in paths)
    res.release()
    assert not any(os.path.exists(p) for p in paths)
