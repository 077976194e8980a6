"""Filter rows of sheets: single runs, batches, and the index of conditions."""

import os

import pytest

from gridpull.operators import filters as flt
from gridpull.plans import extract
from gridpull.plans.extract import SheetError, plan_sheet, run, run_batch
from gridpull.sources import read_sheet_cells

from test_sheet import _write
from test_streaming_batch import CFG, _batch_files

HEAD = ",Header,id,voyage_id,StartDate,name,,when\n,StartDate\n,Voyage ID,a,b,c\n"
ROWS = [
    (1, "a", "2025-01-01 00:00:00", "one", 1.0),
    (2, "a", "2025-01-02 00:00:00", "two", 2.0),
    (3, "b", "2025-01-03 00:00:00", "a%b", -0.0),
    (4, "b", "2025-01-04 00:00:00", None, None),
    (5, "c", "2025-01-05 00:00:00", "Two", 2.5),
    (6, "c", None, "one", 1.0),
]


def fact(spark):
    df = spark.createDataFrame(ROWS, "id int, voyage_id string, d string, name string, x double")
    return df.selectExpr("id", "voyage_id", "cast(d as timestamp_ntz) as voyage_date_voyagestart", "name", "x", "cast(d as date) as `when`")


# filter rows (under id, voyage_id, StartDate, name, no name, when) -> ids
CASES = {
    "": {1, 2, 3, 4, 5, 6},
    ",Filter\n": {1, 2, 3, 4, 5, 6},
    ",Filter,,,not a condition,,nor this\n": {1, 2, 3, 4, 5, 6},
    ",Filter, 2 \n": {2},
    ",Filter,x\n": set(),
    ",Filter,,a\n": {1, 2},
    ",Filter,,a,,one\n": {1},
    ",Filter,,a,,one\n, filter ,,c\n": {1, 5, 6},
    ",Filter,,,,%o%\n": {1, 2, 5, 6},
    ",Filter,,,,t%\n,Filter,5\n,FILTER,null\n": {2, 5},
    ",Filter,,,,a\\%b\n": {3},
    ",Filter,,,,,,2025-01-04\n": {4},
    ",Filter,,,,,,2025-01-0%\n,Filter,6,c,,one\n": {1, 2, 3, 4, 5, 6},
    ",Filter,,c,,one\n,Filter,,a,,two\n,Filter,,b,,two\n": {2, 6},
}


SINGLE = (",Filter,x\n", ",Filter,,,,t%\n,Filter,5\n,FILTER,null\n")


@pytest.mark.parametrize("literals", [500, 0])
def test_single_runs(spark, scratch, literals, monkeypatch):
    monkeypatch.setattr(flt, "MAX_LITERAL_ATOMS", literals)
    for i, rows in enumerate(SINGLE):
        ids = CASES[rows]
        res = run(spark, _write(scratch, f"s{i}.csv", HEAD + rows), fact(spark), CFG, count_fetched=True)
        assert {r["id"] for r in res.result.collect()} == ids, rows
        assert res.metrics["fetched_rows"] == len(ids), rows


def test_batch_equals_single_runs(spark, scratch):
    every = [_write(scratch, f"s{i}.csv", HEAD + rows) for i, rows in enumerate(CASES)]
    out = os.path.join(scratch, "out")
    done = run_batch(spark, every, fact(spark), CFG, out_path=out)
    got = _batch_files(out)
    found = [(r["sheet"].rsplit("/")[-1], r["id"]) for r in done.result.select("sheet", "id").collect()]
    for i, (rows, ids) in enumerate(CASES.items()):
        assert {k for s, k in found if s == f"s{i}.csv"} == ids, rows
        if rows in SINGLE:
            one = os.path.join(scratch, "one.csv")
            run(spark, every[i], fact(spark), CFG, out_path=one)
            assert got[f"s{i}.csv"] == open(one, "rb").read(), rows
    done.release()


def test_unknown_column_is_an_error(spark, scratch):
    bad = _write(scratch, "bad.csv", HEAD.replace("name", "nowhere") + ",Filter,,,,x\n")
    good = _write(scratch, "good.csv", HEAD + ",Filter,,a\n")
    with pytest.raises(SheetError, match="lacks: 'nowhere'"):
        run(spark, bad, fact(spark), CFG)
    done = run_batch(spark, [bad, good], fact(spark), CFG)
    assert [(r["sheet"].rsplit("/")[-1], "nowhere" in r["error"]) for r in done.errors.collect()] == [("bad.csv", True)]
    assert {r["id"] for r in done.result.collect()} == {1, 2}


def test_filters_reach_the_scan(spark, scratch):
    path = os.path.join(scratch, "fact")
    fact(spark).write.parquet(path)
    res = run(spark, _write(scratch, "s.csv", HEAD + ",Filter,2\n"), spark.read.parquet(path), CFG)
    plan = res.result._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,2)" in plan


def test_a_thousand_groups_are_looked_up(spark, scratch):
    """Many groups of one sheet become an index, not a chain of ORs."""
    rows = "".join(f",Filter,{i},a\n" for i in range(2, 1000))
    res = run(spark, _write(scratch, "many.csv", HEAD + rows), fact(spark), CFG)
    assert {r["id"] for r in res.result.collect()} == {2}
    plan = plan_sheet(read_sheet_cells(spark, os.path.join(scratch, "many.csv")), CFG)
    assert plan.filters.count() == 2 * 998
    assert extract.sheet_filters(plan, fact(spark))[1] is not None


# every kind of pattern: with % at its ends only, between, escaped, with _
PATTERNS = ("%", "%%", "o%", "%o", "%n%", "%one", "one%", "%One%", "o%e", "%\\%%", "a\\%%", "%w_", "%a%b%", "%.%", "t%,Filter")


def test_patterns_of_the_index_are_like(spark):
    texts = ["", "one", "two", "Two", "a%b", "a.b", "on\ne", "x_y", None]
    rows = spark.createDataFrame([(p, i, t) for p in PATTERNS for i, t in enumerate(texts)], "sheet string, i int, name string")
    atoms = spark.createDataFrame([(p, 1, "name", "like", p) for p in PATTERNS], "sheet string, g int, name string, op string, value string")
    index = flt.filter_index(atoms, rows, ["name"])
    got = {(r["sheet"], r["i"]) for r in flt.filter_rows(rows, index, ["name"], 100).collect()}
    assert got == {(r["sheet"], r["i"]) for r in rows.where("name like sheet").collect()}
    kinds = {x["value"]: x["kind"] for r in index.collect() for x in r["likes"]}
    assert {p for p, k in kinds.items() if k == "like"} == {"o%e", "%\\%%", "a\\%%", "%w_", "%a%b%", "t%,Filter"}


def test_only_cells_of_the_header_and_the_labels_are_cleaned(spark, scratch):
    """No costly condition of header or label cells is pushed to the scan of all cells."""
    _write(scratch, "s.csv", HEAD + ",Filter,5\n")
    cells = extract.materialize(read_sheet_cells(spark, scratch))
    mk = extract.materialize(extract.marker_table(cells))
    for df in (extract.header_names(cells, mk, broadcast_mk=True), flt.filter_atoms(cells, mk, broadcast_mk=True)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scans = [a + b for a, b in zip(plan, plan[1:]) if "Relation [" in b]
        assert scans and not any("regexp_replace" in x for x in scans), scans



def test_block_sheets_stand_in_folders_of_bounded_number(spark, scratch):
    from gridpull.plans import derived

    spark.range(1, 40_000, 50).selectExpr("id as c_custkey").write.parquet(os.path.join(scratch, "customer.parquet"))
    root = derived.write_block_sheets(spark, scratch).removeprefix("file:")
    found = {d: sorted(x for x in os.listdir(os.path.join(root, d)) if x.startswith("sheet=")) for d in os.listdir(root) if d.startswith("folder=")}
    assert sorted(len(x) for x in found.values()) == [32, 64, 64]
    assert {x for xs in found.values() for x in xs} == {f"sheet={b}" for b in range(160)}
