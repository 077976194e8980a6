"""Sheet fixtures: marker discovery, header list, parameter sets, end to end."""

import datetime as dt
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gridpull.config import ExtractConfig
from gridpull.operators import find_markers, header_names, marker_scan, marker_table, param_errors, param_sets
from gridpull.plans.derived import SEGMENT_SHEET_CELLS_SQL, segment_cells, segment_shape, write_segment_sheets
from gridpull.plans.extract import SheetError, plan_sheet, run
from gridpull.sources import read_sheet_cells, read_sheet_grid, sheet_shape
from gridpull.sources import sheet as sheet_source

from conftest import SF001

HERE = os.path.dirname(os.path.abspath(__file__))
S1 = os.path.join(HERE, "fixtures", "sheets", "s1.csv")
T = dt.datetime


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def _s1_text():
    with open(S1, encoding="utf-8") as f:
        return f.read()


def test_cells_markers_header_params(spark):
    cells = read_sheet_cells(spark, S1)
    grid = read_sheet_grid(spark, S1)
    assert cells.count() == 30  # non-blank cells (64 with blanks)
    shape = sheet_shape(cells, grid).first()
    assert (shape.n_rows, shape.n_cols) == (8, 8)
    assert [r.c for r in marker_scan(cells).collect()] == [1]
    m = {r.role: (r.r, r.c) for r in find_markers(cells).collect()}
    assert m == {"header": (2, 1), "start": (3, 1), "end": (4, 1), "id": (6, 1)}
    mk = marker_table(cells)
    names = [r.name for r in header_names(cells, mk).orderBy("c").collect()]
    assert names == ["voyage_date_voyagestart", "voyage_id", "rate_usd", "voyage_expense_desc"]
    ps = [(r.c, r.id, r.start, r.end) for r in param_sets(cells, mk).orderBy("c").collect()]
    assert ps == [
        (2, "250101/AAA/BBB", T(2025, 7, 3), T(2025, 7, 10)),
        (3, "250202/CCC DDD", T(2025, 8, 12), T(2025, 8, 17, 23, 59, 59)),
        (4, "250202/CCC DDD", T(2025, 10, 4), T(2025, 10, 8, 12, 30)),
        (5, "250303/EEE", None, None),
    ]
    errs = [(r.r, r.c, r.v) for r in param_errors(cells, mk).collect()]
    assert errs == [(3, 5, "not a date")]


def test_missing_markers(spark, scratch):
    body = _s1_text().splitlines()
    no_header = _write(scratch, "s2.csv", "\n".join(l for l in body if ",Header," not in l) + "\n")
    with pytest.raises(SheetError, match="reads 'Header'"):
        plan_sheet(read_sheet_cells(spark, no_header), ExtractConfig())
    no_id = _write(scratch, "s3.csv", "\n".join(l for l in body if ",Voyage ID," not in l) + "\n")
    with pytest.raises(SheetError, match="reads 'Voyage ID'"):
        plan_sheet(read_sheet_cells(spark, no_id), ExtractConfig())
    empty_header = _write(scratch, "s5.csv", "\n".join(",Header,,,,,," if ",Header," in l else l for l in body) + "\n")
    with pytest.raises(SheetError, match="nothing stands right of 'Header'"):
        plan_sheet(read_sheet_cells(spark, empty_header), ExtractConfig())


def test_short_title_and_no_bounds(spark, scratch):
    body = _s1_text().splitlines()
    short = _write(scratch, "s7.csv", "\n".join(["Query sheet"] + body[1:]) + "\n")
    p7 = plan_sheet(read_sheet_cells(spark, short), ExtractConfig())
    assert p7.header == ["voyage_date_voyagestart", "voyage_id", "rate_usd", "voyage_expense_desc"]
    assert p7.params.count() == 4
    nob = _write(scratch, "s4.csv", "\n".join(l for l in body if "Date," not in l) + "\n")
    p4 = plan_sheet(read_sheet_cells(spark, nob), ExtractConfig())
    rows = p4.params.collect()
    assert len(rows) == 4 and all(r.start is None and r.end is None for r in rows)


def test_leading_zero_ids_stay_text(spark, scratch):
    text = "x,Header,voyage_id\n,StartDate,2025-01-01\n,Voyage ID,007,,0012\n"
    p = plan_sheet(read_sheet_cells(spark, _write(scratch, "s8.csv", text)), ExtractConfig())
    assert sorted(r.id for r in p.params.collect()) == ["0012", "007"]


F2 = [
    (1, "250101/AAA/BBB", "2025-07-03 00:00:00", "a"),
    (2, "250101/AAA/BBB", "2025-07-10 00:00:00", "b"),
    (3, "250101/AAA/BBB", "2025-07-10 00:00:01", "c"),
    (4, "250202/CCC DDD", "2025-08-17 23:59:59", "d"),
    (5, "250202/CCC DDD", "2025-08-17 23:59:59", "e"),
    (6, "250202/CCC DDD", "2025-08-18 00:00:00", "f"),
    (7, "250202/CCC DDD", "2025-10-08 12:30:00", 'say "hi", ok'),
    (8, "250202/CCC DDD", None, "h"),
    (9, "250303/EEE", None, None),
    (10, "250303/EEE", "2024-01-01 00:00:00.5", "j"),
    (11, "250303/eee", "2025-01-01 00:00:00", "k"),
    (12, None, "2025-07-04 00:00:00", "l"),
    (13, "250202/CCC  DDD", "2025-08-13 00:00:00", "m"),
]


def _fact(spark):
    return spark.createDataFrame(F2, "id int, voyage_id string, d string, voyage_expense_desc string").select(
        "id", "voyage_id", F.col("d").cast("timestamp_ntz").alias("voyage_date_voyagestart"), "voyage_expense_desc"
    )


@pytest.mark.parametrize("strategy,hot", [("auto", 64), ("broadcast", 64), ("shuffle", 64), ("shuffle", 0)])
def test_end_to_end_strategies(spark, strategy, hot):
    from gridpull.plans.extract import extract_rows

    cfg = ExtractConfig(tie_break=("id",), hot_id_sets=hot, buckets_per_hot_id=8)
    fact = _fact(spark)
    plan = plan_sheet(read_sheet_cells(spark, S1), cfg)
    out = extract_rows(fact, plan.params, cfg, plan.header + ["id"], strategy=strategy).collect()
    assert [r.id for r in out] == [10, 1, 2, 4, 7, 9]


def test_end_to_end_csv(spark, scratch):
    cfg = ExtractConfig(tie_break=("id",))
    out = os.path.join(scratch, "results", "out.csv")
    res = run(spark, S1, _fact(spark), cfg, out_path=out, count_fetched=True)
    assert res.metrics == {"fetched_rows": 7, "rows": 6}
    data = open(out, "rb").read()
    assert data.startswith(b"\xef\xbb\xbf")
    text = data.decode("utf-8-sig")
    assert text == (
        "voyage_date_voyagestart,voyage_id,rate_usd,voyage_expense_desc\n"
        "2024-01-01T00:00:00.5,250303/EEE,,j\n"
        "2025-07-03T00:00:00,250101/AAA/BBB,,a\n"
        "2025-07-10T00:00:00,250101/AAA/BBB,,b\n"
        "2025-08-17T23:59:59,250202/CCC DDD,,d\n"
        '2025-10-08T12:30:00,250202/CCC DDD,,"say ""hi"", ok"\n'
        ",250303/EEE,,\n"
    )
    assert res.observation.get["rows"] == 6


def test_zero_sets_gives_header_only(spark, scratch):
    text = "x,Header,voyage_id,voyage_date_voyagestart\n,StartDate,2025-01-01\n,Voyage ID,,null\n"
    sheet = _write(scratch, "s6.csv", text)
    out = os.path.join(scratch, "out6.csv")
    run(spark, sheet, _fact(spark), ExtractConfig(tie_break=("id",)), out_path=out)
    body = open(out, encoding="utf-8-sig").read()
    assert body == "voyage_id,voyage_date_voyagestart\n"


def test_header_without_keys_and_duplicate_sets(spark, scratch):
    from gridpull.plans.extract import extract_rows

    cfg = ExtractConfig(tie_break=("id",))
    # S-9: neither id nor date is asked for; both still drive the match and de-dup.
    s9 = _write(scratch, "s9.csv", ",Header,voyage_expense_desc\n,StartDate,2025-07-03\n,EndDate,2025-07-10 00:00\n,Voyage ID,250101/AAA/BBB\n")
    p9 = plan_sheet(read_sheet_cells(spark, s9), cfg)
    out9 = extract_rows(_fact(spark), p9.params, cfg, p9.header)
    assert out9.columns == ["voyage_expense_desc"]
    assert [r.voyage_expense_desc for r in out9.collect()] == ["a", "b"]
    # S-10: a repeated set changes nothing.
    one = _write(scratch, "s10a.csv", ",Header,id\n,StartDate,8/12/2025\n,EndDate,2025-08-17\n,Voyage ID,250202/CCC DDD\n")
    two = _write(scratch, "s10b.csv", ",Header,id\n,StartDate,8/12/2025,8/12/2025\n,EndDate,2025-08-17,2025-08-17\n,Voyage ID,250202/CCC DDD,250202/CCC DDD\n")
    res = []
    for path in (one, two):
        p = plan_sheet(read_sheet_cells(spark, path), cfg)
        res.append([r.id for r in extract_rows(_fact(spark), p.params, cfg, p.header).collect()])
    assert res[0] == res[1] == [4]


def test_derived_sheets_have_pages_of_bounded_width(spark):
    """No file is wider than a page, however many customers a segment has."""
    path = write_segment_sheets(spark, "/root/testdata/sf0.1")
    got = read_sheet_grid(spark, path).agg(F.max(F.size("row")).alias("w"), F.count_distinct("sheet").alias("n")).first()
    assert got["w"] <= 1000 and got["n"] == 18


@pytest.mark.parametrize("width", [10, 11, 17, 32])
def test_derived_sheets_do_not_depend_on_the_page_width(spark, width):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{SF001}/customer.parquet'")
    got = segment_cells(spark, SF001, width).select("sheet", "r", "c", "v").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"WITH {SEGMENT_SHEET_CELLS_SQL} SELECT sheet, r, c, v FROM cells").fetchall())
    shape = segment_shape(spark, SF001, width).select("sheet", "n_rows", "n_cols").collect()
    assert sorted(map(tuple, shape)) == sorted(con.execute(f"WITH {SEGMENT_SHEET_CELLS_SQL} SELECT sheet, max(r) + 1, max(c) + 1 FROM cells GROUP BY sheet").fetchall())


# What Spark's own reader makes of odd records.
RECORDS = [
    'a,"b""c",d', 'a,"b\\"c",d', 'a,"b"x,d', 'a,b"c,d"e,f', '"a,b",c', ' "a,b",c', '"a" ,c', 'a,"",c', 'a,,c', 'a,"b\\\\",c', 'a,"b\\c",d',
    'a,"b""",c', 'a,"""b""",c', '"",', "a\\,b,c", '"a""b,c",d', '"x"y"z",w', '\\"a,b', '"a\\"","b"', '"a""', 'a,"b"",c",d', '"a"b"c,d"e,f',
    ",", ",,x", " ", "007, 1.50 ,x\ty", "ä,\u3000,\"ö,ü\"", '"two\nlines",x', '"three\n\nlines\n",,"and, two\nmore"', 'a"b\nc', '"esc\\"\n\\",still",end',
]


def spark_csv(spark, path, width=12):
    kind = ", ".join(f"c{i} string" for i in range(width))
    reader = spark.read.schema(kind).option("multiLine", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    rows = [list(r) for r in reader.csv(path).collect()]
    return [(i, c, v) for i, r in enumerate(rows) for c, v in enumerate(r) if v is not None]


def ours(spark, path):
    return sorted((r["r"], r["c"], r["v"]) for r in read_sheet_cells(spark, path).collect())


def test_fields_are_cut_like_sparks_reader(spark, scratch):
    clean = _write(scratch, "clean.csv", "\n".join(r for r in RECORDS if "\n" not in r) + "\n\n")
    assert ours(spark, clean) == spark_csv(spark, clean)
    broken = _write(scratch, "broken.csv", "\n\n".join(RECORDS) + "\n")
    assert ours(spark, broken) == spark_csv(spark, broken)


def test_random_sheets_are_read_like_sparks_reader(spark, scratch):
    rng = random.Random(11)

    def field():
        body = "".join(rng.choices(["a", "b", " ", "ü", ",", "\n", '\\"', "\\\\", "-"], k=rng.randrange(6)))
        return '"' + body + '"' if rng.random() < 0.5 else body.replace(",", "").replace("\n", "").replace("\\", "").replace('"', "")

    text = "\n".join(",".join(field() for _ in range(rng.randrange(1, 6))) for _ in range(400)) + "\n"
    path = _write(scratch, "random.csv", text)
    assert ours(spark, path) == spark_csv(spark, path)


def test_one_file_is_read_by_several_tasks(spark, scratch):
    """Byte ranges of one file; quoted line breaks span their borders."""
    rng = random.Random(3)
    rows = [[f"r{i}", "x" * rng.randrange(30), '"q ' + "line\n" * rng.randrange(4) + 'end, \\"' + "y" * rng.randrange(20) + '"'] for i in range(300)]
    text = "\n".join(("\n" if i % 7 == 0 else "") + ",".join(r) for i, r in enumerate(rows)) + "\n"
    path = _write(scratch, "ranges.csv", text)
    want = spark_csv(spark, path)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert sheet_source._lines(spark, [path]).select("b").distinct().count() > 20
        assert ours(spark, path) == want
        flat = _write(scratch, "flat.csv", "".join(f"{i},x,\n" + "\n" * (i % 3 == 0) for i in range(500)))
        assert ours(spark, flat) == sorted((i, c, v) for i in range(500) for c, v in enumerate((str(i), "x")))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_very_wide_sheet(spark, scratch):
    path = _write(scratch, "wide.csv", "a" + "," * 200_000 + "z\nb,c\n")
    assert ours(spark, path) == [(0, 0, "a"), (0, 200_000, "z"), (1, 0, "b"), (1, 1, "c")]
