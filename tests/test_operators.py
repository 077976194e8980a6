"""Operator checks on the driver tables plus metamorphic properties."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridpull.config import ExtractConfig
from gridpull.operators import (
    conform,
    dedup_first,
    ids_missing,
    merge_ranges,
    or_groups,
    page,
    param_join,
    param_match,
    project,
    schema_for,
    set_counts,
    with_position,
)
from gridpull.operators.joins import prepared_sets
from gridpull.plans.catalog import LINEITEM_CFG, LINEITEM_HEADER, LINEITEM_SETS, literal_params
from gridpull.plans.extract import extract_rows
from gridpull.sources import part_files, write_csv

SF = "/root/testdata/sf0.01"


def _li(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_known_counts(spark):
    li = _li(spark)
    p = literal_params(spark)
    assert param_join(li, p, LINEITEM_CFG, set_key=("c",)).count() == 906
    assert extract_rows(li, p, LINEITEM_CFG, LINEITEM_HEADER).count() == 741
    counts = {r.c: r.n_rows for r in set_counts(li, p, LINEITEM_CFG, set_key=("c",)).collect()}
    assert counts == {1: 106, 2: 80, 3: 82, 4: 638, 5: 0}
    assert [r.id for r in ids_missing(li, p, LINEITEM_CFG).collect()] == ["-1"]


def test_semi_equals_join_then_dedup(spark):
    li = _li(spark)
    p = literal_params(spark)
    keys = ["l_suppkey", "l_shipdate"]
    order = list(LINEITEM_HEADER[2:])
    joined = param_join(li, p, LINEITEM_CFG, set_key=("c",)).drop("c")
    a = dedup_first(joined, keys, order)
    b = dedup_first(param_match(li, p, LINEITEM_CFG), keys, order)
    assert _rows(a) == _rows(b)


@pytest.mark.parametrize("strategy", ["literal", "broadcast", "shuffle"])
def test_strategies_agree(spark, strategy):
    li = _li(spark)
    p = literal_params(spark)
    want = _rows(extract_rows(li, p, LINEITEM_CFG, LINEITEM_HEADER, strategy="literal"))
    assert _rows(extract_rows(li, p, LINEITEM_CFG, LINEITEM_HEADER, strategy=strategy)) == want


def test_duplicate_shuffled_and_split_sets(spark):
    li = _li(spark)
    base = _rows(extract_rows(li, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER))
    dup = LINEITEM_SETS + (LINEITEM_SETS[0],)
    assert _rows(extract_rows(li, literal_params(spark, dup), LINEITEM_CFG, LINEITEM_HEADER)) == base
    shuffled = list(LINEITEM_SETS)
    random.Random(7).shuffle(shuffled)
    assert _rows(extract_rows(li, literal_params(spark, tuple(shuffled)), LINEITEM_CFG, LINEITEM_HEADER)) == base
    # Split set 1 at mid-year; whole-second data, so the second part starts 1 s later.
    split = (
        ("3", "1996-01-01 00:00:00", "1996-06-15 12:00:00"),
        ("3", "1996-06-15 12:00:01", "1996-12-31 23:59:59"),
    ) + LINEITEM_SETS[1:]
    assert _rows(extract_rows(li, literal_params(spark, split), LINEITEM_CFG, LINEITEM_HEADER)) == base


def test_merge_ranges_is_exact(spark):
    rnd = random.Random(11)
    base = dt.datetime(2020, 1, 1)
    sets, probes = [], []
    for i in range(200):
        pid = rnd.randint(0, 4)
        s = None if rnd.random() < 0.1 else base + dt.timedelta(days=rnd.randint(0, 60))
        e = None if rnd.random() < 0.1 else (s or base) + dt.timedelta(days=rnd.randint(0, 10))
        sets.append((pid, s, e))
    for d in range(-5, 90):
        for pid in range(5):
            probes.append((pid, base + dt.timedelta(days=d, hours=12)))
    sdf = spark.createDataFrame(sets, "_pid long, _ps timestamp_ntz, _pe timestamp_ntz")
    merged = merge_ranges(sdf, ["_pid"]).collect()
    # disjoint per id
    by_id = {}
    for r in merged:
        by_id.setdefault(r._pid, []).append((r._ps, r._pe))

    def inside(ranges, d):
        return any((a is None or d >= a) and (b is None or d <= b) for a, b in ranges)

    raw = {}
    for pid, s, e in sets:
        raw.setdefault(pid, []).append((s, e))
    for pid, d in probes:
        hits = [1 for a, b in by_id.get(pid, []) if (a is None or d >= a) and (b is None or d <= b)]
        assert len(hits) <= 1
        assert inside(by_id.get(pid, []), d) == inside(raw.get(pid, []), d)


def test_or_groups_and_project_conform(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    groups = [[("o_orderstatus", "=", "F")], [("o_orderpriority", "like", "%HIGH%")]]
    n = o.where(or_groups(groups, "o_orderdate", "1997-01-01 00:00:00", "1997-06-30 23:59:59", df=o)).count()
    assert n == 536
    pr = project(o.limit(2), ["o_orderkey", "nope", "o_orderkey"])
    assert pr.columns == ["o_orderkey", "nope", "o_orderkey"]
    assert {r[1] for r in pr.collect()} == {""}
    from pyspark.sql import types as T

    full = T.StructType([T.StructField("o_totalprice", T.DecimalType(18, 2))])
    c = conform(o, schema_for(["o_totalprice", "extra"], full))
    assert [f.dataType.simpleString() for f in c.schema.fields] == ["decimal(18,2)", "string"]


def test_with_position_and_page(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc_nulls_first()]
    got = {r.o_orderkey: r.pos for r in with_position(o, order).collect()}
    w = Window.orderBy(*order)
    want = {r.o_orderkey: r.pos for r in o.select("o_orderkey", F.row_number().over(w).alias("pos")).collect()}
    assert got == want
    p3 = {r.o_orderkey for r in page(o, order, 3, 2000).collect()}
    assert p3 == {k for k, v in want.items() if 6000 < v <= 8000}


def test_csv_edge_values(spark, scratch):
    vals = [" a ", "b\\c", "x\\", '\\"q', None, "", "t\tab", "c\rr", "n\nl", "#h"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string").orderBy("i")
    out = os.path.join(scratch, "edge.csv")
    write_csv(df, out, single_file=True)
    text = open(out, "rb").read().decode("utf-8")
    assert text.startswith("\ufeffi,v\n")
    assert "0, a \n" in text
    assert "1,b\\c\n" in text
    assert "2,x\\\n" in text
    assert '3,"\\""q"\n' in text
    assert "4,\n5,\n" in text
    assert '"c\rr"' in text and '"n\nl"' in text
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(out)
    assert back.count() == len(vals)


def _random_sets(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        sid = str(rnd.randint(0, 12))
        s = None if rnd.random() < 0.15 else dt.datetime(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 2400))
        e = None if rnd.random() < 0.15 else (s or dt.datetime(1995, 1, 1)) + dt.timedelta(days=rnd.randint(0, 90), seconds=rnd.randint(0, 86399))
        out.append((sid, None if s is None else s.strftime("%Y-%m-%d %H:%M:%S"), None if e is None else e.strftime("%Y-%m-%d %H:%M:%S")))
    out.append(("5", None, None))
    return tuple(out)


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_bucketed_shuffle_join_is_exact(spark, hot):
    li = _li(spark)
    sets = _random_sets(300, 5)
    cfg = LINEITEM_CFG.with_(hot_id_sets=hot, buckets_per_hot_id=64)
    p = literal_params(spark, sets)
    want = _rows(extract_rows(li, p, cfg, LINEITEM_HEADER, strategy="broadcast"))
    got = _rows(extract_rows(li, p, cfg, LINEITEM_HEADER, strategy="shuffle"))
    assert got == want and len(want) > 0


def test_bucketed_shuffle_join_by_sheet(spark):
    li = _li(spark)
    a = literal_params(spark, _random_sets(120, 1), sheet="a")
    b = literal_params(spark, _random_sets(120, 2), sheet="b")
    p = a.unionByName(b)
    cfg = LINEITEM_CFG.with_(hot_id_sets=2, buckets_per_hot_id=16)
    want = _rows(extract_rows(li, p, cfg, LINEITEM_HEADER, by=["sheet"], strategy="broadcast"))
    got = _rows(extract_rows(li, p, cfg, LINEITEM_HEADER, by=["sheet"], strategy="shuffle"))
    assert got == want and len(want) > 0


@pytest.mark.parametrize("parts", [1, 7, 23])
def test_balanced_merge_equals_window_merge(spark, parts):
    from gridpull.operators.joins import merge_ranges_balanced

    rnd = random.Random(parts)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for _ in range(600):
        sheet = rnd.choice(["a", "b"])
        pid = 0 if rnd.random() < 0.6 else rnd.randint(1, 6)  # id 0 is hot
        s = None if rnd.random() < 0.05 else base + dt.timedelta(hours=rnd.randint(0, 2000))
        e = None if rnd.random() < 0.05 else (s or base) + dt.timedelta(hours=rnd.randint(0, 30))
        rows.append((sheet, pid, s, e))
    sdf = spark.createDataFrame(rows, "sheet string, _pid long, _ps timestamp_ntz, _pe timestamp_ntz")
    want = _rows(merge_ranges(sdf, ["sheet", "_pid"]))
    got = _rows(merge_ranges_balanced(sdf, ["sheet", "_pid"], partitions=parts))
    assert got == want


def test_param_join_bucketed_equals_broadcast(spark):
    li = _li(spark)
    p = literal_params(spark, _random_sets(150, 9))
    cfg = LINEITEM_CFG.with_(hot_id_sets=2, buckets_per_hot_id=32)
    want = _rows(param_join(li, p, cfg, set_key=("c",), broadcast=True))
    got = _rows(param_join(li, p, cfg, set_key=("c",), broadcast=False))
    assert got == want and len(want) > 0


def test_union_sets_one_scan(spark):
    from gridpull.operators import union_sets

    li = _li(spark)
    rows = [{"id": i, "start": s, "end": e} for i, s, e in LINEITEM_SETS]
    u = union_sets(li, rows, LINEITEM_CFG)
    assert u.count() == 906
    counts = {r.ord: r["count"] for r in u.groupBy("ord").count().collect()}
    assert counts == {1: 106, 2: 80, 3: 82, 4: 638}


def test_deep_page_uses_positions(spark, monkeypatch):
    from gridpull.operators import ordering

    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc_nulls_first()]
    shallow = {r.o_orderkey for r in ordering.page(o, order, 4, 1000).collect()}
    monkeypatch.setattr(ordering, "TOP_K_PAGE_DEPTH", 10)
    deep = {r.o_orderkey for r in ordering.page(o, order, 4, 1000).collect()}
    assert deep == shallow and len(deep) == 1000


def test_bucketed_join_on_date_column(spark):
    """A date-typed fact column against timestamp bounds with a time part."""
    rows = [(i % 3, dt.date(2024, 1, 1) + dt.timedelta(days=i % 40), i) for i in range(600)]
    fact = spark.createDataFrame(rows, "k long, d date, v long")
    sets = (("1", "2024-01-05 10:00:00", "2024-01-09 00:00:00"), ("1", "2024-01-20 00:00:00", None), ("2", None, "2024-01-03 12:00:00"))
    p = literal_params(spark, sets)
    cfg = ExtractConfig(id_col="k", date_col="d", tie_break=("v",), hot_id_sets=0, buckets_per_hot_id=8)
    want = _rows(extract_rows(fact, p, cfg, ("d", "k", "v"), strategy="broadcast"))
    got = _rows(extract_rows(fact, p, cfg, ("d", "k", "v"), strategy="shuffle"))
    assert got == want and len(want) > 0
    assert all(r[0] != dt.date(2024, 1, 5) or r[1] != 1 for r in want)  # 10:00 start excludes that day


def test_python_float_text(spark):
    from gridpull.sources.csv_sink import python_float_text

    vals = [0.0, -0.0, 1.5, 123.45, 1234567.0, 1e7, 12345678.9, 1.5e15, 1e16, 1.2345e20, 1e100, 0.001, 0.0001,
            0.00015, 1e-05, 1.5e-07, -2.5e-10, -31234567.25, float("nan"), float("inf"), float("-inf"), 473274.17]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r.o for r in df.select("i", python_float_text(F.col("v")).alias("o")).orderBy("i").collect()]
    assert got == [repr(v) for v in vals]


def test_shuffle_path_with_balanced_merge(spark):
    li = _li(spark)
    p = literal_params(spark, _random_sets(300, 21))
    cfg = LINEITEM_CFG.with_(hot_id_sets=3, buckets_per_hot_id=64, window_merge_max_per_key=0)
    want = _rows(extract_rows(li, p, cfg, LINEITEM_HEADER, strategy="broadcast"))
    got = _rows(extract_rows(li, p, cfg, LINEITEM_HEADER, strategy="shuffle"))
    assert got == want and len(want) > 0
