"""What reaches the scan, on every path of the set join."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from gridpull.operators import ids_missing, param_join, param_match, set_counts
from gridpull.plans.catalog import LINEITEM_CFG, literal_params

from conftest import SF001

JANUARY = (("3", "1996-01-05 00:00:00", "1996-01-20 23:59:59"), ("7", "1996-01-01 00:00:00", "1996-01-31 00:00:00"))


def _li(spark):
    return spark.read.parquet(f"{SF001}/lineitem.parquet")


def _pushed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return "\n".join(x for x in buf.getvalue().splitlines() if "PushedFilters" in x and "l_suppkey" in x)


@pytest.mark.parametrize(
    "query",
    [
        lambda li, p: param_match(li, p, LINEITEM_CFG, strategy="shuffle"),
        lambda li, p: param_match(li, p, LINEITEM_CFG, strategy="broadcast"),
        lambda li, p: param_match(li, p, LINEITEM_CFG, strategy="literal"),
        lambda li, p: param_match(li, p, LINEITEM_CFG, by=["sheet"], strategy="shuffle"),
        lambda li, p: param_join(li, p, LINEITEM_CFG),
        lambda li, p: param_join(li, p, LINEITEM_CFG, broadcast=True),
        lambda li, p: param_join(li, p, LINEITEM_CFG, broadcast=False),
        lambda li, p: set_counts(li, p, LINEITEM_CFG),
    ],
    ids=["shuffle", "broadcast", "literal", "by-sheet", "join", "join-broadcast", "join-shuffle", "counts"],
)
def test_dates_and_ids_reach_the_scan(spark, query):
    pushed = _pushed(query(_li(spark), literal_params(spark, JANUARY)))
    assert "1996-01-01" in pushed or "1996-01-05" in pushed
    assert "1996-01-31" in pushed or "1996-01-20" in pushed
    assert "In(l_suppkey, [3,7])" in pushed or "EqualTo(l_suppkey,3)" in pushed


def test_ids_reach_the_scan(spark):
    assert "l_suppkey" in _pushed(ids_missing(_li(spark), literal_params(spark, JANUARY), LINEITEM_CFG))
    assert "EqualTo(l_suppkey,3)" in _pushed(ids_missing(_li(spark), literal_params(spark, JANUARY[:1]), LINEITEM_CFG))


def test_forced_broadcast_keeps_its_bound(spark):
    cfg = LINEITEM_CFG.with_(broadcast_max_sets=1)
    got = param_match(_li(spark), literal_params(spark, JANUARY), cfg, strategy="broadcast")
    assert got.count() == param_match(_li(spark), literal_params(spark, JANUARY), LINEITEM_CFG).count()


@pytest.mark.parametrize("rows", [0, 10**9])
def test_hot_rows_text_dates_and_sentinels(spark, rows):
    """Ids that are hot by rows, open bounds, NULL dates and text dates give
    the rows of the plain predicate."""
    sets = JANUARY + (("12", None, "1995-12-31 23:59:59"), ("12", "1998-01-01 00:00:00", None), ("5", None, None))
    cfg = LINEITEM_CFG.with_(hot_id_rows=rows, hot_id_sets=10**9, buckets_per_hot_id=16)
    li = _li(spark).withColumn("l_shipdate", F.when(F.pmod("l_orderkey", F.lit(9)) != 0, F.col("l_shipdate")))
    want = sorted(map(tuple, param_match(li, literal_params(spark, sets), cfg, strategy="literal").collect()), key=repr)
    got = sorted(map(tuple, param_match(li, literal_params(spark, sets), cfg, strategy="shuffle").collect()), key=repr)
    assert got == want and want
    text = li.withColumn("l_shipdate", F.coalesce(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit("no date")))
    back = param_match(text, literal_params(spark, sets), cfg.with_(broadcast_max_ids=0), strategy="shuffle")
    keys = lambda rows: sorted((r[0], r[3]) for r in rows)
    assert keys(map(tuple, back.collect())) == keys(want)
