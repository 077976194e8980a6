"""Interval index, file index, page copy, ordered union, many patterns."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from gridpull.config import ExtractConfig
from gridpull.operators import joins, like_many, param_join, param_match
from gridpull.operators.pages import page_files, read_page, write_pages
from gridpull.sources import write_clustered
from gridpull.sources.file_index import files_for_sets, read_for_sets, write_file_index

CFG = ExtractConfig(id_col="i", date_col="d", pushdown_max_sets=0, probe_max_sets=2)
DAY = dt.datetime(2024, 1, 1)


def fact_rows(n=120):
    rows = [(k, k % 4, DAY + dt.timedelta(hours=7 * k)) for k in range(n)]
    return rows + [(n, 1, None), (n + 1, 2, None)]


def fact(spark, rows=None):
    df = spark.createDataFrame(rows or fact_rows(), "k int, i int, d timestamp_ntz")
    return df


def sets_rows(seed, n=60):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        s = DAY + dt.timedelta(hours=rng.randrange(900))
        e = s + dt.timedelta(hours=rng.randrange(30))
        out.append((f"s{c % 2}", c, str(rng.choice([1, 1, 1, 0, 3])), s, e))
    out += [("s0", 90, "0", None, DAY + dt.timedelta(hours=9)), ("s1", 91, "3", DAY + dt.timedelta(hours=700), None), ("s1", 92, "2", None, None)]
    out += [("s1", 93, "2", DAY, None), ("s1", 94, "2", DAY, DAY), ("s0", 95, "77", None, None)]
    return out


SETS = "sheet string, c int, id string, start timestamp_ntz, end timestamp_ntz"


def meets(row, s):
    k, i, d = row
    _, _, sid, lo, hi = s
    return str(i) == sid and (d is not None or (lo is None and hi is None)) and (lo is None or d is None or d >= lo) and (hi is None or d is None or d <= hi)


def test_ranges_of_a_hot_id_are_searched(spark):
    sets = sets_rows(1)
    params = spark.createDataFrame(sets, SETS)
    got = param_match(fact(spark), params, CFG)
    assert sorted(r["k"] for r in got.collect()) == sorted(r[0] for r in fact_rows() if any(meets(r, s) for s in sets))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "lambdafunction" in plan.lower()
    by = param_match(fact(spark), params, CFG, by=["sheet"])
    want = sorted((x, r[0]) for x in ("s0", "s1") for r in fact_rows() if any(meets(r, s) for s in sets if s[0] == x))
    assert sorted((r["sheet"], r["k"]) for r in by.collect()) == want


def test_hot_id_keeps_multiplicity(spark):
    sets = sets_rows(2)
    got = param_join(fact(spark), spark.createDataFrame(sets, SETS), CFG.with_(hot_id_sets=4), ("c",))
    assert sorted((r["c"], r["k"]) for r in got.collect()) == sorted((s[1], r[0]) for s in sets for r in fact_rows() if meets(r, s))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9])
def test_binary_search(spark, n):
    starts, ends = [10 * k for k in range(n)], [10 * k + 4 for k in range(n)]
    df = spark.range(-3, 100).select(F.col("id").cast("int").alias("d"))
    arrays = [F.array(*map(F.lit, x)).cast("array<int>") for x in (starts, ends)]
    got = df.where(joins.in_ranges(F.col("d"), *arrays, F.lit(False), n)).collect()
    assert [r["d"] for r in got] == [d for d in range(-3, 100) if any(a <= d <= b for a, b in zip(starts, ends))]


def test_union_in_fetch_order(spark):
    sets = sets_rows(3)
    got = joins.union_sets_ordered(fact(spark), spark.createDataFrame(sets, SETS), CFG, ("sheet", "c"), ("k",)).collect()
    want = []
    for s in sorted(sets, key=lambda s: s[:2]):
        rows = [r for r in fact_rows() if meets(r, s)]
        rows.sort(key=lambda r: (r[2] is None, -(r[2] or DAY).timestamp(), r[0]))
        want += [(s[0], s[1], n + 1, r[0]) for n, r in enumerate(rows)]
    assert [(r["sheet"], r["c"], r["rank"], r["k"]) for r in sorted(got, key=lambda r: r["pos"])] == want
    assert sorted(r["pos"] for r in got) == list(range(1, len(want) + 1))


def test_file_index_skips_files(spark, scratch):
    path, index = os.path.join(scratch, "my fact+1"), os.path.join(scratch, "index")
    write_clustered(fact(spark), path, "i", "d", files=12)
    write_file_index(spark, path, index, "i", "d")
    late = spark.createDataFrame([("x", 1, "3", DAY + dt.timedelta(hours=800), None)], SETS)
    every = spark.read.parquet(path).inputFiles()
    files = files_for_sets(spark, path, index, late, CFG)
    assert 1 <= len(files) <= 2 < len(every)
    read = read_for_sets(spark, path, index, late, CFG)
    assert len(read.inputFiles()) == len(files)
    found = lambda p: sorted(r["k"] for r in param_match(read_for_sets(spark, path, index, p, CFG), p, CFG).collect())
    assert found(late) == [r[0] for r in fact_rows() if r[1] == 3 and r[2] and r[2] >= DAY + dt.timedelta(hours=800)]
    # rows without a date, ids that nobody has, many sets
    assert found(spark.createDataFrame([("x", 1, "2", None, None)], SETS)) == [r[0] for r in fact_rows() if r[1] == 2]
    none = spark.createDataFrame([("x", 1, "99", None, None)], SETS)
    assert files_for_sets(spark, path, index, none, CFG) == [] and found(none) == []
    many = sets_rows(4)
    assert found(spark.createDataFrame(many, SETS)) == sorted(r[0] for r in fact_rows() if any(meets(r, s) for s in many))
    # a file that the index does not know is read
    fact(spark, [(500, 99, DAY)]).coalesce(1).write.mode("append").parquet(path)
    assert found(none) == [500]


def test_pages_read_one_or_two_files(spark, scratch):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("id"), F.lit("x").alias("_part_"))
    path = write_pages(df.repartition(8), [F.col("id")], os.path.join(scratch, "pages dir"))
    for n in (0, 1, 13, 24):
        assert [r["id"] for r in read_page(spark, path, n, 40).collect()] == list(range(n * 40, n * 40 + 40))
        assert 1 <= len(page_files(spark, path, n, 40)) <= 2
    assert read_page(spark, path, 25, 40).collect() == []
    assert read_page(spark, path, 24, 41).columns == ["id", "_part_"]
    empty = write_pages(df.limit(0), [F.col("id")], os.path.join(scratch, "none"))
    assert read_page(spark, empty, 0).collect() == []


def like(pattern):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": "(?s:.*)", "_": "(?s:.)"}.get(c, re.escape(c))
        i += 1
    return re.compile(out)


def test_many_patterns(spark):
    rng = random.Random(7)
    values = ["".join(rng.choices("ab%_\n", k=rng.randrange(7))) for _ in range(150)] + [None, "", "abab", "ü%"]
    patterns = ["".join(rng.choices(["a", "b", "ab", "%", "_", "\\%", "\\_"], k=rng.randrange(1, 6))) for _ in range(150)] + [None, "", "%", "%%", "_%", "nothing like it", "ü\\%"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, i int")
    ps = spark.createDataFrame([(p,) for p in patterns], "p string")
    got = like_many.like_pairs(df.select("v"), ps).collect()
    want = {(v, p) for v in values for p in patterns if v is not None and p is not None and like(p).fullmatch(v)}
    assert sorted(map(tuple, got)) == sorted(want)
    some = spark.createDataFrame([("%ab%b",), ("_",)], "p string")
    hits = {r["i"] for r in like_many.like_any(df, "v", some).collect()}
    assert hits == {i for i, v in enumerate(values) if v is not None and (like("%ab%b").fullmatch(v) or len(v) == 1)}
    assert like_many.like_pairs(df.select("v"), ps.limit(0)).count() == 0


@pytest.mark.parametrize("how", ["rows", "concat"])
def test_one_ordered_file_from_parallel_parts(spark, scratch, how, monkeypatch):
    from gridpull.sources import csv_sink

    joined = []
    if how == "concat":  # a file system that can join files

        def concat(_, first, rest):
            local = lambda p: p.removeprefix("file:")
            joined.append(len(rest))
            with open(local(first), "ab") as f:
                for r in rest:
                    f.write(open(local(r), "rb").read())

        monkeypatch.setattr(csv_sink, "can_concat", lambda *_: True)
        monkeypatch.setattr(csv_sink, "concat", concat)
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 3 == 0, 'a "b"\nc, d').otherwise("é").alias("two\nlines"))
    ordered = df.repartition(4).orderBy(F.col("id").desc())
    out = os.path.join(scratch, "one.csv")
    csv_sink.write_csv(ordered.repartitionByRange(5, F.col("id").desc()).sortWithinPartitions(F.col("id").desc()), out, single_file=1000)
    body = "".join(f'{i},"a ""b""\nc, d"\n' if i % 3 == 0 else f"{i},é\n" for i in reversed(range(500)))
    assert open(out, encoding="utf-8-sig", newline="").read() == 'id,"two\nlines"\n' + body
    assert (joined and joined[0] > 1) or how == "rows"
    csv_sink.write_csv(df.limit(0), out, single_file=1000)
    assert open(out, encoding="utf-8-sig").read() == 'id,"two\nlines"\n'
    if how == "rows":  # more rows than one task should write
        csv_sink.write_csv(df, out, single_file=499)
        assert os.path.isdir(out)


@pytest.mark.parametrize("single", [True, 1000])
def test_one_file_on_a_disk_is_written_by_all_tasks(spark, scratch, single, monkeypatch):
    from gridpull.sources import csv_sink, read_sheet_grid

    joined = []
    join = csv_sink.join_mounted
    monkeypatch.setattr(csv_sink, "join_mounted", lambda spark, parts, *to: (joined.append(len(parts)), join(spark, parts, *to)))
    monkeypatch.setattr(csv_sink, "_merged", lambda *_: pytest.fail("one task holds all rows"))
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 3 == 0, 'a "b"\r\nc').otherwise("é").alias("zwei\r\nä"))
    parts = df.repartitionByRange(5, F.col("id").desc()).sortWithinPartitions(F.col("id").desc())
    out = os.path.join(scratch, "one file é%20.csv")
    for _ in range(2):  # the second takes the first one's place
        csv_sink.write_csv(parts, out, line_sep="\r\n", single_file=single)
        body = "".join(f'{i},"a ""b""\r\nc"\r\n' if i % 3 == 0 else f"{i},é\r\n" for i in reversed(range(500)))
        assert open(out, encoding="utf-8-sig", newline="").read() == 'id,"zwei\r\nä"\r\n' + body
    assert len(joined) == 2 and min(joined) > 1
    assert [f for f in os.listdir(scratch) if ".new-" in f or ".old-" in f] == []
    csv_sink.write_csv(parts.select("id"), out, single_file=single)
    assert [r["row"][0] for r in read_sheet_grid(spark, out).orderBy("r").collect()][1:] == [str(i) for i in reversed(range(500))]


def test_lines_of_byte_ranges_are_numbered_without_a_sort(spark, scratch):
    from gridpull.sources import read_sheet_grid

    texts = {f"f{n}": [f"{n}-{i}" if i % 7 else "" for i in range(n * 300)] for n in (1, 2, 5)}
    for name, lines in texts.items():
        with open(os.path.join(scratch, name), "w") as f:
            f.write("".join(line + "\n" for line in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        grid = read_sheet_grid(spark, scratch)
        plan = grid._jdf.queryExecution().executedPlan().toString()
        got = {(os.path.basename(r["sheet"]), r["r"], r["row"][0]) for r in grid.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(name, r, line) for name, lines in texts.items() for r, line in enumerate(filter(None, lines))}
    assert "Window" not in plan and "Sort" not in plan
