"""Registered queries over the driver tables, each with its DuckDB oracle.

Role mapping of the driver tables onto the sheet workflow's single fact
table:

* ``orders``   fact with a primary key: id ``o_custkey``, date
  ``o_orderdate``, survivor ``o_orderkey``;
* ``lineitem`` duplicate-heavy fact without a key: id ``l_suppkey``, date
  ``l_shipdate``, survivor = smallest full row;
* ``customer`` source of derived parameter sheets / many sets;
* ``part``, ``events`` inputs for the text and date-only rules.

Every query reads whole tables; nothing is sampled or capped except where a
limit is the operator itself (probe, page). Spark builders and oracle SQL sit
side by side so their column names and semantics stay in step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PAGE_SIZE, PROBE_LIMIT, ExtractConfig
from ..functions.dates import coerce_ts, day_start, iso_text, parse_bound
from ..functions.text import clean_id, is_missing, norm_label, sanitize_name
from ..operators.dedup import dedup_first, distinct_rows
from ..operators.joins import ids_missing, ids_present, merge_ranges, param_join, prepared_sets, set_counts, union_sets
from ..operators.markers import find_markers, header_names, marker_scan, marker_table
from ..operators.ordering import fetch_order, page, probe_limit, sort_desc_nulls_last, sort_result, with_position
from ..operators.params import param_errors, param_sets
from ..operators.predicates import date_clause, eq, or_groups
from ..operators.projection import conform, schema_for
from ..operators.sizing import delete_on_exit, materialize, take_at_most
from ..session import ensure_checkpoint_dir
from ..sources.csv_sink import write_csv
from .derived import SEGMENT_SHEET_CELLS_SQL, segment_cells, segment_shape
from .extract import batch_header, extract_rows, plan_sheets

QueryFn = Callable[[SparkSession, str], DataFrame]

ORDERS_CFG = ExtractConfig(id_col="o_custkey", date_col="o_orderdate", tie_break=("o_orderkey",))
LINEITEM_CFG = ExtractConfig(id_col="l_suppkey", date_col="l_shipdate")

# Five parameter sets on lineitem (id, start, end); two overlap on id 3,
# one has only an end, one is open on both sides, one id does not exist.
LINEITEM_SETS = (
    ("3", "1996-01-01 00:00:00", "1996-12-31 23:59:59"),
    ("3", "1996-07-01 00:00:00", "1997-03-31 23:59:59"),
    ("7", None, "1995-12-31 23:59:59"),
    ("12", None, None),
    ("-1", None, None),
)
LINEITEM_HEADER = (
    "l_shipdate",
    "l_suppkey",
    "l_orderkey",
    "l_partkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)
ORDERS_HEADER = ("o_orderdate", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def literal_params(spark: SparkSession, sets=LINEITEM_SETS, sheet: str = "s") -> DataFrame:
    """(sheet, c, id, start, end) from literal (id, start, end) texts; c is
    the 1-based set position."""
    rows = [(sheet, i + 1, i_d, s, e) for i, (i_d, s, e) in enumerate(sets)]
    df = spark.createDataFrame(rows, "sheet string, c int, id string, start string, end string")
    return df.select(
        "sheet", "c", "id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end")
    )


def _sets_sql(sets=LINEITEM_SETS) -> str:
    def ts(v):
        return "NULL::TIMESTAMP" if v is None else f"TIMESTAMP '{v}'"

    vals = ", ".join(f"({i + 1}, '{i_d}', {ts(s)}, {ts(e)})" for i, (i_d, s, e) in enumerate(sets))
    return f"sets(c, id, s, e) AS (VALUES {vals})"


_LI_MATCH_SQL = "l.l_suppkey = TRY_CAST(sets.id AS BIGINT) AND (sets.s IS NULL OR l.l_shipdate >= sets.s) AND (sets.e IS NULL OR l.l_shipdate <= sets.e)"
_LI_SURVIVOR_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in LINEITEM_HEADER[2:])
_LI_COLS_SQL = ", ".join(LINEITEM_HEADER)


# ---------------------------------------------------------------- extraction
def q_param_extract(spark, sf):
    li = _t(spark, sf, "lineitem")
    return extract_rows(li, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER)


SQL_PARAM_EXTRACT = f"""
WITH {_sets_sql()},
m AS (SELECT * FROM lineitem l WHERE EXISTS (SELECT 1 FROM sets WHERE {_LI_MATCH_SQL})),
d AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_LI_SURVIVOR_SQL}) AS rn FROM m)
SELECT {_LI_COLS_SQL} FROM d WHERE rn = 1
"""


def q_param_extract_broadcast(spark, sf):
    li = _t(spark, sf, "lineitem")
    return extract_rows(li, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER, strategy="broadcast")


def q_param_extract_shuffle(spark, sf):
    li = _t(spark, sf, "lineitem")
    return extract_rows(li, literal_params(spark), LINEITEM_CFG, LINEITEM_HEADER, strategy="shuffle")


def customer_sets(spark: SparkSession, sf: str) -> DataFrame:
    """One set per customer: id = custkey text; bounds from the nation key,
    open on one or both sides for some nations."""
    c = _t(spark, sf, "customer")
    nk = F.col("c_nationkey")
    base = F.make_timestamp_ntz(F.lit(1995) + F.pmod(nk, F.lit(5)), F.lit(1) + F.pmod(nk, F.lit(12)), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    start = F.when(F.pmod(nk, F.lit(7)) == 0, F.lit(None)).otherwise(base)
    end = F.when(F.pmod(nk, F.lit(6)) == 0, F.lit(None)).otherwise(F.expr("INTERVAL '730' DAY") + base - F.expr("INTERVAL '1' SECOND"))
    return c.select(
        F.lit("customers").alias("sheet"),
        F.col("c_custkey").cast("int").alias("c"),
        F.col("c_custkey").cast("string").alias("id"),
        start.cast("timestamp_ntz").alias("start"),
        end.cast("timestamp_ntz").alias("end"),
    )


_CUSTOMER_SETS_SQL = """
csets AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE make_timestamp(1995 + c_nationkey % 5, 1 + c_nationkey % 12, 1, 0, 0, 0) END AS s,
         CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE make_timestamp(1995 + c_nationkey % 5, 1 + c_nationkey % 12, 1, 0, 0, 0) + INTERVAL 730 DAY - INTERVAL 1 SECOND END AS e
  FROM customer)
"""
_ORD_SURVIVOR = "o_orderkey ASC NULLS FIRST"
_ORD_COLS = ", ".join(ORDERS_HEADER)


def q_many_sets(spark, sf):
    return extract_rows(_t(spark, sf, "orders"), customer_sets(spark, sf), ORDERS_CFG, ORDERS_HEADER)


SQL_MANY_SETS = f"""
WITH {_CUSTOMER_SETS_SQL},
m AS (SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM csets s WHERE o.o_custkey = TRY_CAST(s.id AS BIGINT)
        AND (s.s IS NULL OR o.o_orderdate >= s.s) AND (s.e IS NULL OR o.o_orderdate <= s.e))),
d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY {_ORD_SURVIVOR}) AS rn FROM m)
SELECT {_ORD_COLS} FROM d WHERE rn = 1
"""


def q_merged_sets(spark, sf):
    """Overlapping ranges per id merged into disjoint ranges (the build side
    of the semi join), for the customer sets plus a shifted copy of them."""
    cfg = ORDERS_CFG
    o = _t(spark, sf, "orders")
    base = customer_sets(spark, sf)
    shifted = base.select(
        "sheet",
        "c",
        "id",
        (F.col("start") + F.expr("INTERVAL '400' DAY")).alias("start"),
        (F.col("end") + F.expr("INTERVAL '400' DAY")).alias("end"),
    )
    sets = prepared_sets(o, base.unionByName(shifted), cfg)
    return merge_ranges(sets, ["_pid"]).select(
        F.col("_pid").alias("id"), F.col("_ps").alias("range_start"), F.col("_pe").alias("range_end")
    )


SQL_MERGED_SETS = f"""
WITH {_CUSTOMER_SETS_SQL},
allsets AS (
  SELECT TRY_CAST(id AS BIGINT) AS id, s, e FROM csets
  UNION ALL
  SELECT TRY_CAST(id AS BIGINT), s + INTERVAL 400 DAY, e + INTERVAL 400 DAY FROM csets),
o AS (SELECT *, max(coalesce(e, TIMESTAMP '9999-12-31 23:59:59.999999')) OVER (PARTITION BY id ORDER BY s ASC NULLS FIRST, e ASC NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end FROM allsets),
g AS (SELECT *, sum(CASE WHEN prev_end IS NULL OR (s IS NOT NULL AND s > prev_end) THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY s ASC NULLS FIRST, e ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM o)
SELECT id,
       CASE WHEN count(s) < count(*) THEN NULL ELSE min(s) END AS range_start,
       CASE WHEN count(e) < count(*) THEN NULL ELSE max(e) END AS range_end
FROM g GROUP BY id, grp
"""


def q_param_join(spark, sf):
    li = _t(spark, sf, "lineitem")
    return param_join(li, literal_params(spark), LINEITEM_CFG, set_key=("c",))


SQL_PARAM_JOIN = f"""
WITH {_sets_sql()}
SELECT sets.c AS c, l.* FROM lineitem l JOIN sets ON {_LI_MATCH_SQL}
"""


def q_union_sets(spark, sf):
    li = _t(spark, sf, "lineitem")
    rows = [{"id": i, "start": s, "end": e} for i, s, e in LINEITEM_SETS]
    return union_sets(li, rows, LINEITEM_CFG)


SQL_UNION_SETS = f"""
WITH {_sets_sql()}
SELECT sets.c AS ord, l.* FROM lineitem l JOIN sets ON {_LI_MATCH_SQL}
"""


def q_set_counts(spark, sf):
    li = _t(spark, sf, "lineitem")
    return set_counts(li, literal_params(spark), LINEITEM_CFG, set_key=("c",)).select("c", "id", "start", "end", "n_rows")


SQL_SET_COUNTS = f"""
WITH {_sets_sql()}
SELECT sets.c AS c, sets.id AS id, sets.s AS "start", sets.e AS "end",
       (SELECT count(*) FROM lineitem l WHERE {_LI_MATCH_SQL}) AS n_rows
FROM sets
"""


def q_row_counts(spark, sf):
    """Rows fetched over all sets (with multiplicity) and rows after de-dup,
    from one pass over the join output."""
    li = _t(spark, sf, "lineitem").select("l_suppkey", "l_shipdate")
    j = param_join(li, literal_params(spark), LINEITEM_CFG, set_key=("c",))
    return j.agg(
        F.count(F.lit(1)).alias("fetched_rows"),
        F.count_distinct(F.struct("l_suppkey", "l_shipdate")).alias("final_rows"),
    )


SQL_ROW_COUNTS = f"""
WITH {_sets_sql()},
j AS (SELECT l.l_suppkey, l.l_shipdate FROM lineitem l JOIN sets ON {_LI_MATCH_SQL})
SELECT count(*) AS fetched_rows, count(DISTINCT (l_suppkey, l_shipdate)) AS final_rows FROM j
"""


def q_ids_missing(spark, sf):
    return ids_missing(_t(spark, sf, "lineitem"), literal_params(spark), LINEITEM_CFG)


SQL_IDS_MISSING = f"""
WITH {_sets_sql()}
SELECT DISTINCT id FROM sets WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey = TRY_CAST(sets.id AS BIGINT))
"""


def q_ids_present(spark, sf):
    return ids_present(_t(spark, sf, "orders"), customer_sets(spark, sf), ORDERS_CFG)


SQL_IDS_PRESENT = f"""
WITH {_CUSTOMER_SETS_SQL}
SELECT DISTINCT id FROM csets WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = TRY_CAST(csets.id AS BIGINT))
"""


def q_probe_limit(spark, sf):
    li = _t(spark, sf, "lineitem")
    order = [F.col("l_shipdate").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in LINEITEM_HEADER[2:]]]
    return probe_limit(li.select("l_suppkey", "l_shipdate", *LINEITEM_HEADER[2:]), "l_suppkey", LINEITEM_SETS[0][0], order, PROBE_LIMIT)


SQL_PROBE_LIMIT = f"""
SELECT l_suppkey, l_shipdate, {", ".join(LINEITEM_HEADER[2:])} FROM lineitem WHERE l_suppkey = 3
ORDER BY l_shipdate DESC NULLS LAST, {_LI_SURVIVOR_SQL} LIMIT {PROBE_LIMIT}
"""


def q_empty_result(spark, sf):
    sets = literal_params(spark, (("-1", None, None),))
    return extract_rows(_t(spark, sf, "orders"), sets, ORDERS_CFG, ORDERS_HEADER)


SQL_EMPTY_RESULT = f"SELECT {_ORD_COLS} FROM orders WHERE o_custkey = -1"


def q_select_cols(spark, sf):
    """Header without the id and date columns: both are still used for the
    set match and de-dup, neither is written."""
    sets = literal_params(spark, (("769", None, None), ("3", "1996-01-01 00:00:00", None)))
    return extract_rows(_t(spark, sf, "orders"), sets, ORDERS_CFG, ("o_orderkey", "o_totalprice"))


SQL_SELECT_COLS = """
WITH m AS (SELECT * FROM orders WHERE o_custkey = 769 OR (o_custkey = 3 AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00')),
d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn FROM m)
SELECT o_orderkey, o_totalprice FROM d WHERE rn = 1
"""


def q_project_missing(spark, sf):
    sets = literal_params(spark, (("3", None, None),))
    return extract_rows(_t(spark, sf, "orders"), sets, ORDERS_CFG, ("o_orderkey", "rate_usd", "o_orderdate"))


SQL_PROJECT_MISSING = """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn
           FROM orders WHERE o_custkey = 3)
SELECT o_orderkey, '' AS rate_usd, o_orderdate FROM d WHERE rn = 1
"""


def q_project_final(spark, sf):
    """Header order differs from the table order and repeats nothing."""
    sets = literal_params(spark, (("769", None, None),))
    return extract_rows(_t(spark, sf, "orders"), sets, ORDERS_CFG, ("o_orderpriority", "o_totalprice", "o_custkey"))


SQL_PROJECT_FINAL = """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn
           FROM orders WHERE o_custkey = 769)
SELECT o_orderpriority, o_totalprice, o_custkey FROM d WHERE rn = 1
"""


def q_conform_schema(spark, sf):
    full = T.StructType(
        [
            T.StructField("o_orderkey", T.IntegerType(), False),
            T.StructField("o_totalprice", T.DecimalType(18, 2), True),
            T.StructField("o_orderdate", T.TimestampNTZType(), True),
            T.StructField("o_orderpriority", T.StringType(), True),
        ]
    )
    want = ["o_orderdate", "o_orderkey", "o_totalprice", "o_comment_text"]
    return conform(_t(spark, sf, "orders"), schema_for(want, full))


SQL_CONFORM_SCHEMA = """
SELECT o_orderdate, TRY_CAST(o_orderkey AS INTEGER) AS o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(NULL AS VARCHAR) AS o_comment_text FROM orders
"""


# ------------------------------------------------------------------- filters
def q_filter_eq(spark, sf):
    o = _t(spark, sf, "orders")
    return o.where(eq("o_custkey", "769", o.schema["o_custkey"].dataType))


SQL_FILTER_EQ = "SELECT * FROM orders WHERE o_custkey = TRY_CAST('769' AS BIGINT)"


def q_filter_gte(spark, sf):
    o = _t(spark, sf, "orders")
    return o.where(eq("o_custkey", "769", o.schema["o_custkey"].dataType) & date_clause("o_orderdate", start="1998-01-01 00:00:00"))


SQL_FILTER_GTE = "SELECT * FROM orders WHERE o_custkey = 769 AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"


def q_filter_lte(spark, sf):
    o = _t(spark, sf, "orders")
    return o.where(eq("o_custkey", "769", o.schema["o_custkey"].dataType) & date_clause("o_orderdate", end="1997-12-31 23:59:59"))


SQL_FILTER_LTE = "SELECT * FROM orders WHERE o_custkey = 769 AND o_orderdate <= TIMESTAMP '1997-12-31 23:59:59'"


def q_filter_between(spark, sf):
    return _t(spark, sf, "orders").where(date_clause("o_orderdate", "1997-01-01 00:00:00", "1997-01-31 23:59:59"))


SQL_FILTER_BETWEEN = "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-01-31 23:59:59'"


def q_filter_date_only(spark, sf):
    """Date-only bounds: both become midnight, so the end day itself is only
    included at 00:00:00."""
    ev = _t(spark, sf, "events")
    lo = day_start(F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    hi = day_start(F.lit("2024-01-07 23:59:59").cast("timestamp_ntz"))
    return ev.where((F.col("ts") >= lo) & (F.col("ts") <= hi))


SQL_FILTER_DATE_ONLY = "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-07 00:00:00'"


def q_extract_date_only(spark, sf):
    """The date-only switch on a whole extraction (events: user_id as id)."""
    cfg = ExtractConfig(id_col="user_id", date_col="ts", tie_break=("event_id",), date_only=True)
    ev = _t(spark, sf, "events")
    sets = literal_params(spark, (("7", "2024-01-05 10:00:00", "2024-01-20 23:59:59"), ("46", None, "2024-01-09 08:00:00")))
    return extract_rows(ev, sets, cfg, ("ts", "user_id", "event_id", "event_type", "value"))


SQL_EXTRACT_DATE_ONLY = """
WITH m AS (SELECT * FROM events WHERE (user_id = 7 AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00')
                                   OR (user_id = 46 AND ts <= TIMESTAMP '2024-01-09 00:00:00')),
d AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id ASC NULLS FIRST) AS rn FROM m)
SELECT ts, user_id, event_id, event_type, value FROM d WHERE rn = 1
"""


def q_filter_or_groups(spark, sf):
    o = _t(spark, sf, "orders")
    groups = [[("o_orderstatus", "=", "F")], [("o_orderpriority", "like", "%HIGH%")]]
    return o.where(or_groups(groups, "o_orderdate", "1997-01-01 00:00:00", "1997-06-30 23:59:59", df=o))


SQL_FILTER_OR_GROUPS = """
SELECT * FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority LIKE '%HIGH%')
  AND o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-06-30 23:59:59'
"""


def q_is_missing(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    txt = (
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None).cast("string"))
        .when(F.pmod(k, F.lit(5)) == 1, F.lit("  "))
        .when(F.pmod(k, F.lit(5)) == 2, F.lit(" Null "))
        .when(F.pmod(k, F.lit(5)) == 3, F.lit("nil"))
        .otherwise(k.cast("string"))
    )
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", is_missing("txt").alias("missing"))


SQL_IS_MISSING = """
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' Null ' WHEN 3 THEN 'nil'
                                  ELSE CAST(o_orderkey AS VARCHAR) END AS txt FROM orders)
SELECT o_orderkey, txt, (txt IS NULL OR trim(txt) = '' OR upper(trim(txt)) = 'NULL') AS missing FROM t
"""


# ------------------------------------------------------------- dedup / sort
def q_dedup_id_date(spark, sf):
    o = _t(spark, sf, "orders")
    return dedup_first(o, ["o_custkey", "o_orderdate"], ["o_orderkey"])


SQL_DEDUP_ID_DATE = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn FROM orders) WHERE rn = 1
"""


def q_dedup_id(spark, sf):
    """Latest order per customer (ties: lowest order key)."""
    o = _t(spark, sf, "orders")
    return dedup_first(o, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc_nulls_first()])


SQL_DEDUP_ID = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS FIRST) AS rn FROM orders) WHERE rn = 1
"""


def q_dedup_row(spark, sf):
    return distinct_rows(_t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate"))


SQL_DEDUP_ROW = "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem"


def _orders_with_null_dates(spark, sf):
    o = _t(spark, sf, "orders")
    d = F.when(F.pmod(F.col("o_orderkey"), F.lit(10)) == 0, F.lit(None)).otherwise(F.col("o_orderdate")).cast("timestamp_ntz")
    return o.select("o_orderkey", "o_custkey", d.alias("o_orderdate"))


_ORD_NULL_SQL = "o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders)"


def q_sort_date_id(spark, sf):
    ensure_checkpoint_dir(spark)
    o = _orders_with_null_dates(spark, sf)
    return with_position(sort_result(o, "o_orderdate", "o_custkey", ["o_orderkey"]))


SQL_SORT_DATE_ID = f"""
WITH {_ORD_NULL_SQL}
SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate ASC NULLS LAST, o_custkey ASC NULLS LAST, o_orderkey ASC NULLS FIRST) AS pos FROM o
"""


def q_sort_date(spark, sf):
    ensure_checkpoint_dir(spark)
    o = _orders_with_null_dates(spark, sf)
    return with_position(sort_result(o, "o_orderdate", None, ["o_orderkey"]))


SQL_SORT_DATE = f"""
WITH {_ORD_NULL_SQL}
SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS FIRST) AS pos FROM o
"""


def q_sort_desc_nulls_last(spark, sf):
    ensure_checkpoint_dir(spark)
    o = _orders_with_null_dates(spark, sf)
    return with_position(sort_desc_nulls_last(o, "o_orderdate", ["o_orderkey"]))


SQL_SORT_DESC_NULLS_LAST = f"""
WITH {_ORD_NULL_SQL}
SELECT o_orderkey, o_custkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS FIRST) AS pos FROM o
"""


def q_page_n(spark, sf):
    o = _t(spark, sf, "orders")
    return page(o, fetch_order("o_orderdate", ["o_orderkey"]), 3, PAGE_SIZE)


SQL_PAGE_N = f"SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS FIRST LIMIT {PAGE_SIZE} OFFSET {3 * PAGE_SIZE}"


# -------------------------------------------------------------- text / dates
def q_norm_label(spark, sf):
    p = _t(spark, sf, "part").select("p_name").distinct()
    return p.select("p_name", norm_label("p_name").alias("label"))


SQL_NORM_LABEL = r"""
SELECT p_name, regexp_replace(regexp_replace(lower(trim(p_name)), '\s+', '_', 'g'), '[^0-9a-z_]+', '', 'g') AS label
FROM (SELECT DISTINCT p_name FROM part)
"""


def q_sanitize_name(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderpriority").distinct()
    return o.select("o_orderpriority", sanitize_name("o_orderpriority").alias("name"))


SQL_SANITIZE_NAME = r"""
SELECT o_orderpriority, regexp_replace(lower(trim(o_orderpriority)), '[-\s]+', '_', 'g') AS name
FROM (SELECT DISTINCT o_orderpriority FROM orders)
"""


def q_clean_id(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_custkey").cast("string")
    m = F.pmod(F.col("o_orderkey"), F.lit(6))
    raw = (
        F.when(m == 0, F.concat(F.lit(" '"), k, F.lit("' ")))
        .when(m == 1, F.concat(F.lit('"'), k, F.lit('"')))
        .when(m == 2, F.concat(F.lit("'\""), k, F.lit("\"'")))
        .when(m == 3, F.concat(F.lit("  "), k, F.lit("   x  ")))
        .when(m == 4, F.lit(" NULL "))
        .otherwise(F.concat(F.lit("'"), F.lit(" "), k, F.lit("'")))
    )
    return o.select("o_orderkey", raw.alias("raw")).select("o_orderkey", "raw", clean_id("raw").alias("id"))


SQL_CLEAN_ID = """
WITH t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS k, o_orderkey % 6 AS m FROM orders)
SELECT o_orderkey,
       CASE m WHEN 0 THEN ' ''' || k || ''' ' WHEN 1 THEN '"' || k || '"' WHEN 2 THEN '''"' || k || '"'''
              WHEN 3 THEN '  ' || k || '   x  ' WHEN 4 THEN ' NULL ' ELSE ''' ' || k || '''' END AS raw,
       CASE m WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k WHEN 3 THEN k || ' x' WHEN 4 THEN NULL ELSE ' ' || k END AS id
FROM t
"""

# Spellings of a date d (Java pattern for Spark, strftime for DuckDB) and
# what a start / end bound reads from them: 'same', 'day' (date only: end
# moves to 23:59:59) or None (unreadable).
_SPELLINGS = (
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S", "same"),
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ", "same"),
    ("'UTC 'yyyy-MM-dd HH:mm", "UTC %Y-%m-%d %H:%M", "same"),
    ("M/d/yyyy H:mm", "%-m/%-d/%Y %-H:%M", "same"),
    ("yyyy-M-d", "%Y-%-m-%-d", "day"),
    ("MM/dd/yyyy", "%m/%d/%Y", "day"),
    ("yy-MM-dd", "%y-%m-%d", None),
    ("yyyy-MM-dd HH:mm:ss'.5'", "%Y-%m-%d %H:%M:%S.5", None),
    ("yyyy-MM-dd HH:mm:'60'", "%Y-%m-%d %H:%M:60", None),
    ("M/d/yyyy H:mm:'61'", "%-m/%-d/%Y %-H:%M:61", None),
)


def _spelled_dates(spark, sf):
    o = _t(spark, sf, "orders")
    m = F.pmod(F.col("o_orderkey"), F.lit(len(_SPELLINGS)))
    txt = None
    for i, (jp, _, _) in enumerate(_SPELLINGS):
        t = F.date_format("o_orderdate", jp)
        txt = F.when(m == i, t) if txt is None else txt.when(m == i, t)
    return o.select("o_orderkey", txt.alias("txt"))


def _spelled_sql(is_end: bool) -> str:
    txt = " ".join(f"WHEN {i} THEN strftime(o_orderdate, '{dp}')" for i, (_, dp, _) in enumerate(_SPELLINGS))
    exp = []
    for i, (_, _, kind) in enumerate(_SPELLINGS):
        if kind == "same":
            exp.append(f"WHEN {i} THEN o_orderdate")
        elif kind == "day":
            exp.append(f"WHEN {i} THEN date_trunc('day', o_orderdate)" + (" + INTERVAL '23:59:59'" if is_end else ""))
        else:
            exp.append(f"WHEN {i} THEN NULL")
    n = len(_SPELLINGS)
    return (
        f"SELECT o_orderkey, CASE o_orderkey % {n} {txt} END AS txt, "
        f"CAST(CASE o_orderkey % {n} {' '.join(exp)} END AS TIMESTAMP) AS bound FROM orders"
    )


def q_parse_start(spark, sf):
    return _spelled_dates(spark, sf).select("o_orderkey", "txt", parse_bound("txt").alias("bound"))


def q_parse_end(spark, sf):
    return _spelled_dates(spark, sf).select("o_orderkey", "txt", parse_bound("txt", is_end=True).alias("bound"))


def q_iso_bounds(spark, sf):
    """Start bounds as the ISO text a request carries."""
    return _spelled_dates(spark, sf).select("o_orderkey", "txt", iso_text(parse_bound("txt")).alias("bound_text"))


def _iso_sql() -> str:
    return (
        "SELECT o_orderkey, txt, strftime(bound, '%Y-%m-%dT%H:%M:%S') AS bound_text FROM ("
        + _spelled_sql(False)
        + ")"
    )


def q_coerce_ts(spark, sf):
    o = _t(spark, sf, "orders")
    m = F.pmod(F.col("o_orderkey"), F.lit(3))
    txt = (
        F.when(m == 0, F.lit("bad"))
        .when(m == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss'.25'"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", coerce_ts("txt").alias("ts"))


SQL_COERCE_TS = """
SELECT o_orderkey,
       CASE o_orderkey % 3 WHEN 0 THEN 'bad' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.25'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt,
       CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate + INTERVAL 250 MILLISECOND ELSE o_orderdate END AS ts
FROM orders
"""


# --------------------------------------------------------------------- sheets
_NORM_SQL = "regexp_replace(regexp_replace(lower(trim({x})), '\\s+', '_', 'g'), '[^0-9a-z_]+', '', 'g')"
_MARKERS_SQL = (
    SEGMENT_SHEET_CELLS_SQL
    + """,
norm AS (SELECT *, {n} AS n FROM cells),
cand AS (SELECT DISTINCT sheet, c FROM norm WHERE n IN ('header', 'startdate')),
hits AS (SELECT x.sheet, x.r, x.c, CASE x.n WHEN 'header' THEN 'header' WHEN 'startdate' THEN 'start'
                                         WHEN 'enddate' THEN 'end' WHEN 'voyage_id' THEN 'id' END AS role
         FROM norm x JOIN cand USING (sheet, c) WHERE x.n IN ('header', 'startdate', 'enddate', 'voyage_id')),
markers AS (SELECT sheet, role, r, c FROM (SELECT *, row_number() OVER (PARTITION BY sheet, role ORDER BY r, c) AS rn FROM hits) WHERE rn = 1),
mk AS (SELECT sheet,
              max(CASE WHEN role = 'header' THEN r END) AS header_r, max(CASE WHEN role = 'header' THEN c END) AS header_c,
              max(CASE WHEN role = 'start' THEN r END) AS start_r, max(CASE WHEN role = 'end' THEN r END) AS end_r,
              max(CASE WHEN role = 'id' THEN r END) AS id_r, max(CASE WHEN role = 'id' THEN c END) AS id_c
       FROM markers GROUP BY sheet)
""".replace("{n}", _NORM_SQL.format(x="v"))
)


def _parse_sql(x: str, is_end: bool) -> str:
    p = f"replace(regexp_replace(CASE WHEN upper(substr(trim({x}), 1, 4)) = 'UTC ' THEN trim(substr(trim({x}), 5)) ELSE trim({x}) END, 'Z$', ''), 'T', ' ')"
    full = ", ".join(f"try_strptime({p}, '{f}')" for f in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M"))
    day = f"coalesce(try_strptime({p}, '%Y-%m-%d'), try_strptime({p}, '%m/%d/%Y'))"
    if is_end:
        day = f"({day} + INTERVAL '23:59:59')"
    return f"CAST(coalesce({full}, {day}) AS TIMESTAMP)"


_CLEAN_ID_SQL = (
    "CASE WHEN {s} = '' OR upper({s}) = 'NULL' OR {s} IS NULL THEN NULL ELSE regexp_replace({s}, '\\s+', ' ', 'g') END"
).format(s="regexp_replace(regexp_replace(trim(id_raw), '^''+|''+$', '', 'g'), '^\"+|\"+$', '', 'g')")

_PARAMS_SQL = (
    _MARKERS_SQL
    + """,
raw AS (SELECT x.sheet, x.c,
               max(CASE WHEN x.r = mk.id_r THEN x.v END) AS id_raw,
               max(CASE WHEN x.r = mk.start_r THEN x.v END) AS start_raw,
               max(CASE WHEN x.r = mk.end_r THEN x.v END) AS end_raw
        FROM cells x JOIN mk USING (sheet)
        WHERE x.c > mk.id_c AND (x.r = mk.id_r OR x.r = mk.start_r OR x.r = mk.end_r)
        GROUP BY x.sheet, x.c),
params AS (SELECT sheet, c, {cid} AS id, {ps} AS "start", {pe} AS "end", start_raw, end_raw FROM raw)
""".replace("{cid}", _CLEAN_ID_SQL)
    .replace("{ps}", _parse_sql("start_raw", False))
    .replace("{pe}", _parse_sql("end_raw", True))
)


def _segment_plan(spark, sf):
    """Stored cells and marker rows of the derived sheets; the marker table
    (one row per sheet) becomes a local table behind a counted bound, else it
    is written once and joined without a broadcast."""
    cells = materialize(segment_cells(spark, sf))
    mk = marker_table(cells)
    rows = take_at_most(mk, ORDERS_CFG.broadcast_max_sheets)
    if rows is None:
        return cells, materialize(mk), False, False
    return cells, spark.createDataFrame(rows, mk.schema), True, not any(r["non_ascii"] for r in rows)


def q_sheet_cells(spark, sf):
    return segment_cells(spark, sf)


SQL_SHEET_CELLS = "WITH " + SEGMENT_SHEET_CELLS_SQL + " SELECT sheet, r, c, v FROM cells"


def q_sheet_shape(spark, sf):
    return segment_shape(spark, sf)


SQL_SHEET_SHAPE = "WITH " + SEGMENT_SHEET_CELLS_SQL + " SELECT sheet, max(r) + 1 AS n_rows, max(c) + 1 AS n_cols FROM cells GROUP BY sheet"


def q_marker_scan(spark, sf):
    return marker_scan(segment_cells(spark, sf))


SQL_MARKER_SCAN = "WITH " + _MARKERS_SQL + " SELECT sheet, c FROM cand"


def q_marker_find(spark, sf):
    return find_markers(segment_cells(spark, sf))


SQL_MARKER_FIND = "WITH " + _MARKERS_SQL + " SELECT sheet, role, r, c FROM markers"


def q_header_cols(spark, sf):
    cells, mk, few, ascii_only = _segment_plan(spark, sf)
    return header_names(cells, mk, broadcast_mk=few, ascii_only=ascii_only)


SQL_HEADER_COLS = (
    "WITH "
    + _MARKERS_SQL
    + """,
h AS (SELECT x.sheet, x.c, regexp_replace(lower(trim(x.v)), '[-\\s]+', '_', 'g') AS name
      FROM cells x JOIN mk USING (sheet)
      WHERE x.r = mk.header_r AND x.c > mk.header_c AND NOT (trim(x.v) = '' OR upper(trim(x.v)) = 'NULL'))
SELECT sheet, c, name FROM h WHERE """
    + _NORM_SQL.format(x="name")
    + " NOT IN ('startdate', 'enddate')"
)


def q_param_sets(spark, sf):
    cells, mk, few, ascii_only = _segment_plan(spark, sf)
    return param_sets(cells, mk, ascii_only=ascii_only, broadcast_mk=few)


SQL_PARAM_SETS = "WITH " + _PARAMS_SQL + ' SELECT sheet, c, id, "start", "end" FROM params WHERE id IS NOT NULL'


def q_param_errors(spark, sf):
    cells, mk, few, ascii_only = _segment_plan(spark, sf)
    return param_errors(cells, mk, ascii_only=ascii_only, broadcast_mk=few)


SQL_PARAM_ERRORS = (
    "WITH "
    + _PARAMS_SQL
    + """
SELECT p.sheet, mk.start_r AS r, p.c, p.start_raw AS v FROM params p JOIN mk USING (sheet)
 WHERE p.id IS NOT NULL AND NOT (p.start_raw IS NULL OR trim(p.start_raw) = '' OR upper(trim(p.start_raw)) = 'NULL') AND p."start" IS NULL
UNION ALL
SELECT p.sheet, mk.end_r AS r, p.c, p.end_raw AS v FROM params p JOIN mk USING (sheet)
 WHERE p.id IS NOT NULL AND NOT (p.end_raw IS NULL OR trim(p.end_raw) = '' OR upper(trim(p.end_raw)) = 'NULL') AND p."end" IS NULL
"""
)

def q_sheet_extract(spark, sf):
    """Many sheets in one job: every segment sheet's sets against orders,
    per-sheet de-dup, result keyed by sheet."""
    mk, names, params, errs = plan_sheets(segment_cells(spark, sf), ORDERS_CFG)
    return extract_rows(_t(spark, sf, "orders"), params, ORDERS_CFG, batch_header(names), by=["sheet"])


SQL_SHEET_EXTRACT = (
    "WITH "
    + _PARAMS_SQL
    + """,
m AS (SELECT p.sheet, o.* FROM orders o JOIN params p ON o.o_custkey = TRY_CAST(p.id AS BIGINT)
        AND (p."start" IS NULL OR o.o_orderdate >= p."start") AND (p."end" IS NULL OR o.o_orderdate <= p."end")
      WHERE p.id IS NOT NULL),
d AS (SELECT *, row_number() OVER (PARTITION BY sheet, o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn FROM m)
SELECT sheet, o_orderdate, o_custkey, o_totalprice, '' AS rate_usd, '' AS voyage_id, o_orderkey FROM d WHERE rn = 1
"""
)


def q_write_csv(spark, sf):
    """Sink round trip: the lineitem extract written with the result-file
    conventions into the shared checkpoint folder, then read back."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    out = f"{base.rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_csv(q_param_extract(spark, sf), out)
    delete_on_exit(spark, out)
    return spark.read.option("header", "true").option("encoding", "UTF-8").csv(out)


SQL_WRITE_CSV = (
    "SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS l_shipdate, "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in LINEITEM_HEADER[1:])
    + f" FROM ({SQL_PARAM_EXTRACT})"
)


def q_nfkc_id(spark, sf):
    """Ids spelled with full-width digits, cleaned like sheet ids."""
    o = _t(spark, sf, "orders")
    wide = F.translate(F.col("o_custkey").cast("string"), "0123456789", "０１２３４５６７８９")
    return o.select("o_orderkey", clean_id(F.concat(F.lit("\u00a0'"), wide, F.lit("' "))).alias("id"))


SQL_NFKC_ID = "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS id FROM orders"

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {
    "param_extract": (q_param_extract, SQL_PARAM_EXTRACT),
    "param_extract_broadcast": (q_param_extract_broadcast, SQL_PARAM_EXTRACT),
    "param_extract_shuffle": (q_param_extract_shuffle, SQL_PARAM_EXTRACT),
    "many_sets": (q_many_sets, SQL_MANY_SETS),
    "merged_sets": (q_merged_sets, SQL_MERGED_SETS),
    "param_join": (q_param_join, SQL_PARAM_JOIN),
    "union_sets": (q_union_sets, SQL_UNION_SETS),
    "set_counts": (q_set_counts, SQL_SET_COUNTS),
    "row_counts": (q_row_counts, SQL_ROW_COUNTS),
    "ids_missing": (q_ids_missing, SQL_IDS_MISSING),
    "ids_present": (q_ids_present, SQL_IDS_PRESENT),
    "probe_limit": (q_probe_limit, SQL_PROBE_LIMIT),
    "empty_result": (q_empty_result, SQL_EMPTY_RESULT),
    "select_cols": (q_select_cols, SQL_SELECT_COLS),
    "project_final": (q_project_final, SQL_PROJECT_FINAL),
    "project_missing": (q_project_missing, SQL_PROJECT_MISSING),
    "conform_schema": (q_conform_schema, SQL_CONFORM_SCHEMA),
    "filter_eq": (q_filter_eq, SQL_FILTER_EQ),
    "filter_gte": (q_filter_gte, SQL_FILTER_GTE),
    "filter_lte": (q_filter_lte, SQL_FILTER_LTE),
    "filter_between": (q_filter_between, SQL_FILTER_BETWEEN),
    "filter_date_only": (q_filter_date_only, SQL_FILTER_DATE_ONLY),
    "extract_date_only": (q_extract_date_only, SQL_EXTRACT_DATE_ONLY),
    "filter_or_groups": (q_filter_or_groups, SQL_FILTER_OR_GROUPS),
    "is_missing": (q_is_missing, SQL_IS_MISSING),
    "dedup_id_date": (q_dedup_id_date, SQL_DEDUP_ID_DATE),
    "dedup_id": (q_dedup_id, SQL_DEDUP_ID),
    "dedup_row": (q_dedup_row, SQL_DEDUP_ROW),
    "sort_date_id": (q_sort_date_id, SQL_SORT_DATE_ID),
    "sort_date": (q_sort_date, SQL_SORT_DATE),
    "sort_desc_nulls_last": (q_sort_desc_nulls_last, SQL_SORT_DESC_NULLS_LAST),
    "page_n": (q_page_n, SQL_PAGE_N),
    "norm_label": (q_norm_label, SQL_NORM_LABEL),
    "sanitize_name": (q_sanitize_name, SQL_SANITIZE_NAME),
    "clean_id": (q_clean_id, SQL_CLEAN_ID),
    "parse_start": (q_parse_start, _spelled_sql(False)),
    "parse_end": (q_parse_end, _spelled_sql(True)),
    "iso_bounds": (q_iso_bounds, _iso_sql()),
    "coerce_ts": (q_coerce_ts, SQL_COERCE_TS),
    "sheet_cells": (q_sheet_cells, SQL_SHEET_CELLS),
    "sheet_shape": (q_sheet_shape, SQL_SHEET_SHAPE),
    "marker_scan": (q_marker_scan, SQL_MARKER_SCAN),
    "marker_find": (q_marker_find, SQL_MARKER_FIND),
    "header_cols": (q_header_cols, SQL_HEADER_COLS),
    "param_sets": (q_param_sets, SQL_PARAM_SETS),
    "param_errors": (q_param_errors, SQL_PARAM_ERRORS),
    "sheet_extract": (q_sheet_extract, SQL_SHEET_EXTRACT),
    "write_csv": (q_write_csv, SQL_WRITE_CSV),
    "nfkc_id": (q_nfkc_id, SQL_NFKC_ID),
}
