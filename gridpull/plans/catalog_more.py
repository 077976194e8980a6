"""More registered queries with their oracles: filter rows of sheets, many
sets of one id, indexes of a stored table, ordered unions, many patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import PAGE_SIZE
from ..operators.joins import union_sets_ordered
from ..operators.like_many import like_pairs
from ..operators.ordering import sort_result
from ..operators.pages import read_page, write_pages
from ..operators.sizing import delete_on_exit
from ..session import ensure_checkpoint_dir
from ..sources.csv_sink import write_csv
from ..sources.file_index import read_for_sets, write_file_index
from ..sources.layout import write_clustered
from ..sources.sheet import read_sheet_grid
from .catalog import (
    _CUSTOMER_SETS_SQL,
    _LI_COLS_SQL,
    _LI_SURVIVOR_SQL,
    _ORD_COLS,
    LINEITEM_CFG,
    LINEITEM_HEADER,
    ORDERS_CFG,
    ORDERS_HEADER,
    QueryFn,
    _t,
    customer_sets,
)
from .derived import BLOCK_CUSTOMERS, BLOCK_START, write_block_sheets
from .extract import extract_rows, run_batch


def _folder(spark, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


# ---------------------------------------------------- filter rows of the sheet
def q_sheet_filter_groups(spark, sf):
    """Every customer block's sheet against orders, under its own filter rows."""
    done = run_batch(spark, write_block_sheets(spark, sf), _t(spark, sf, "orders"), ORDERS_CFG)
    return done.result.withColumn("sheet", F.regexp_extract("sheet", "/sheet=([^/]+)/", 1).cast("long"))


SQL_SHEET_FILTER_GROUPS = f"""
WITH cust AS (SELECT c_custkey AS k, c_custkey // {BLOCK_CUSTOMERS} AS b, min(c_custkey) OVER (PARTITION BY c_custkey // {BLOCK_CUSTOMERS}) AS first FROM customer),
m AS (
  SELECT b, o.* FROM orders o JOIN cust ON o_custkey = k
  WHERE (k % 3 <> 0 OR o_orderdate >= TIMESTAMP '{BLOCK_START} 00:00:00')
    AND CASE b % 4 WHEN 0 THEN true WHEN 1 THEN o_orderstatus = 'F'
             WHEN 2 THEN (o_orderstatus = 'O' AND o_orderpriority LIKE '1-%') OR o_custkey = first
             ELSE o_orderpriority LIKE '%LOW%' OR (o_orderstatus = 'P' AND CAST(o_orderkey AS VARCHAR) LIKE '%3') END),
d AS (SELECT *, row_number() OVER (PARTITION BY b, o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn FROM m)
SELECT b AS sheet, o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM d WHERE rn = 1
"""


# --------------------------------------------------------- many sets of one id
def hot_sets(spark, sf):
    """One set per order against lineitem: a third of them ask for supplier 1,
    the others for all suppliers; each range lasts three hours."""
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=(k * 7919) % 86400)
    return o.select(
        F.lit("orders").alias("sheet"),
        k.cast("int").alias("c"),
        F.when(k % 3 == 0, F.lit("1")).otherwise((F.col("o_custkey") % 100).cast("string")).alias("id"),
        start.alias("start"),
        (start + F.expr("INTERVAL '3' HOUR")).alias("end"),
    )


_HOT_SETS_SQL = """
hsets AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey % 100 END AS id, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS s,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400 + 10800) AS e
  FROM orders)
"""


def q_param_extract_hot_id(spark, sf):
    return extract_rows(_t(spark, sf, "lineitem"), hot_sets(spark, sf), LINEITEM_CFG, LINEITEM_HEADER)


SQL_PARAM_EXTRACT_HOT_ID = f"""
WITH {_HOT_SETS_SQL},
m AS (SELECT * FROM lineitem l WHERE EXISTS (SELECT 1 FROM hsets h WHERE l.l_suppkey = h.id AND l.l_shipdate >= h.s AND l.l_shipdate <= h.e)),
d AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY {_LI_SURVIVOR_SQL}) AS rn FROM m)
SELECT {_LI_COLS_SQL} FROM d WHERE rn = 1
"""


# -------------------------------------------------------- ordered union of sets
def q_union_sets_ordered(spark, sf):
    got = union_sets_ordered(_t(spark, sf, "orders"), customer_sets(spark, sf), ORDERS_CFG, ("c",), ("o_orderkey",))
    return got.select("c", "pos", "rank", *ORDERS_HEADER)


SQL_UNION_SETS_ORDERED = f"""
WITH {_CUSTOMER_SETS_SQL},
m AS (SELECT CAST(s.id AS INTEGER) AS c, o.* FROM orders o JOIN csets s ON o.o_custkey = TRY_CAST(s.id AS BIGINT)
        AND (s.s IS NULL OR o.o_orderdate >= s.s) AND (s.e IS NULL OR o.o_orderdate <= s.e))
SELECT c, row_number() OVER (ORDER BY c, o_orderdate DESC NULLS LAST, o_orderkey) AS pos,
       row_number() OVER (PARTITION BY c ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS "rank", {_ORD_COLS} FROM m
"""


# ------------------------------------------------------------------- deep pages
def q_page_deep(spark, sf):
    """Two pages from the middle of lineitem's order, both from one sorted copy."""
    order = [F.col(c).asc_nulls_first() for c in LINEITEM_HEADER]
    li = _t(spark, sf, "lineitem").select(*LINEITEM_HEADER)
    path = write_pages(li, order, _folder(spark, "pages"))
    middle = li.count() // PAGE_SIZE // 2
    pages = [read_page(spark, path, n).withColumn("page_no", F.lit(n).cast("long")) for n in (middle, middle + 1)]
    return pages[0].unionByName(pages[1])


SQL_PAGE_DEEP = f"""
WITH r AS (SELECT {_LI_COLS_SQL}, row_number() OVER (ORDER BY {", ".join(f"{c} ASC NULLS FIRST" for c in LINEITEM_HEADER)}) - 1 AS p FROM lineitem),
n AS (SELECT (SELECT count(*) FROM lineitem) // {PAGE_SIZE} // 2 AS middle)
SELECT {_LI_COLS_SQL}, p // {PAGE_SIZE} AS page_no FROM r, n WHERE p // {PAGE_SIZE} IN (middle, middle + 1)
"""


# ---------------------------------------------------------------- data skipping
_RICHEST_SQL = f"(SELECT c_custkey // {BLOCK_CUSTOMERS} FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1)"


def q_skip_index_extract(spark, sf):
    """The sets of the richest customer's block against a clustered copy of
    orders, of which only the files that may answer them are read."""
    path, index = _folder(spark, "orders"), _folder(spark, "orders-index")
    write_clustered(_t(spark, sf, "orders"), path, "o_custkey", "o_orderdate")
    write_file_index(spark, path, index, "o_custkey", "o_orderdate")
    cust = _t(spark, sf, "customer")
    best = cust.orderBy(F.desc("c_acctbal"), "c_custkey").limit(1).select(F.floor(F.col("c_custkey") / BLOCK_CUSTOMERS).alias("block"))
    sets = customer_sets(spark, sf).join(F.broadcast(best), F.floor(F.col("c") / BLOCK_CUSTOMERS) == F.col("block"), "left_semi")
    return extract_rows(read_for_sets(spark, path, index, sets, ORDERS_CFG), sets, ORDERS_CFG, ORDERS_HEADER)


SQL_SKIP_INDEX_EXTRACT = f"""
WITH {_CUSTOMER_SETS_SQL},
m AS (SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM csets s WHERE o.o_custkey = TRY_CAST(s.id AS BIGINT)
        AND CAST(s.id AS BIGINT) // {BLOCK_CUSTOMERS} = {_RICHEST_SQL}
        AND (s.s IS NULL OR o.o_orderdate >= s.s) AND (s.e IS NULL OR o.o_orderdate <= s.e))),
d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey ASC NULLS FIRST) AS rn FROM m)
SELECT {_ORD_COLS} FROM d WHERE rn = 1
"""


# ---------------------------------------------------------------- many patterns
def q_like_many(spark, sf):
    """Customer names against a pattern for each part (its key's last three
    digits and its size), and some patterns without a literal."""
    part = _t(spark, sf, "part")
    k = F.col("p_partkey")
    tail = F.lpad((k % 1000).cast("string"), 3, "0")
    pattern = (
        F.when(k % 50 == 0, F.concat(F.lit("%"), F.lpad(F.lit("_"), F.lit(1) + k % 20, "_")))
        .when(k % 3 == 0, F.concat(F.lit("Cust%#%"), tail))
        .when(k % 3 == 1, F.concat(F.lit("%"), F.col("p_size").cast("string"), F.lit("_"), F.substring(tail, 1, 1)))
        .otherwise(F.concat(F.lit("%0"), F.substring(tail, 1, 2), F.lit("_")))
    )
    names = _t(spark, sf, "customer").select("c_name")
    found = like_pairs(names, part.select(pattern))
    return found.groupBy("pattern").agg(F.count("*").alias("n_values"), F.min("value").alias("first_value"))


SQL_LIKE_MANY = """
WITH p AS (SELECT DISTINCT CASE
    WHEN p_partkey % 50 = 0 THEN '%' || repeat('_', 1 + p_partkey % 20)
    WHEN p_partkey % 3 = 0 THEN 'Cust%#%' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')
    WHEN p_partkey % 3 = 1 THEN '%' || p_size || '_' || substr(lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0'), 1, 1)
    ELSE '%0' || substr(lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0'), 1, 2) || '_' END AS pattern FROM part)
SELECT pattern, count(*) AS n_values, min(c_name) AS first_value FROM p JOIN (SELECT DISTINCT c_name FROM customer) ON c_name LIKE pattern GROUP BY pattern
"""


# ------------------------------------------------------------- one ordered file
def q_write_csv_single(spark, sf):
    """All orders in (date, id, key) order as one file, read back with each
    row's line number."""
    o = _t(spark, sf, "orders").orderBy("o_orderdate", "o_custkey", "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    out = _folder(spark, "csv")
    write_csv(o, out, single_file=True)
    lines = read_sheet_grid(spark, out).where("r > 0")
    return lines.select(F.col("r").cast("long").alias("line_no"), *[F.col("row")[i].alias(c) for i, c in enumerate(o.columns)])


SQL_WRITE_CSV_SINGLE = """
SELECT row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_custkey NULLS FIRST, o_orderkey NULLS FIRST) AS line_no, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(o_custkey AS VARCHAR) AS o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, o_orderpriority FROM orders
"""


# ------------------------------------------------------------ no date, no sort
def q_sort_no_date(spark, sf):
    """A frame without the date column is left as it is."""
    return sort_result(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderdate", "o_custkey")


SQL_SORT_NO_DATE = "SELECT o_orderkey, o_custkey FROM orders"


MORE: dict[str, tuple[QueryFn, str | None]] = {
    "sheet_filter_groups": (q_sheet_filter_groups, SQL_SHEET_FILTER_GROUPS),
    "param_extract_hot_id": (q_param_extract_hot_id, SQL_PARAM_EXTRACT_HOT_ID),
    "union_sets_ordered": (q_union_sets_ordered, SQL_UNION_SETS_ORDERED),
    "page_deep": (q_page_deep, SQL_PAGE_DEEP),
    "skip_index_extract": (q_skip_index_extract, SQL_SKIP_INDEX_EXTRACT),
    "like_many": (q_like_many, SQL_LIKE_MANY),
    "sort_no_date": (q_sort_no_date, SQL_SORT_NO_DATE),
    "write_csv_single": (q_write_csv_single, SQL_WRITE_CSV_SINGLE),
}
