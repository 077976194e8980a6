"""Parameter sheets derived from the driver tables.

The registered sheet queries must read the given tables, so their sheets
are built by Spark from ``customer``: one sheet per market segment, one
parameter set (sheet column) per customer. The fixed part of each sheet is
a title, the label column and a header row; the variable part spells each
customer's id and bounds in the different ways a hand-filled sheet does
(quoted ids, unpadded dates, ``UTC`` / ``Z`` decorations, unreadable text,
blank cells). A sheet is as wide as its segment has customers, so it is
written as pages: CSV files of up to ``PAGE_COLUMNS`` of its columns each,
which the queries read like any sheet and put side by side again as cells.
The number of files and groups grows with the table, no line, group or reader
schema does. Customers are numbered by a distributed sort.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_position
from ..operators.sizing import broadcast_if_small, delete_on_exit
from ..session import ensure_checkpoint_dir
from ..sources import grid_to_cells, read_sheet_grid, sheet_shape

# --- Fixed values -----------------------------------------------------------
# Layout of every derived sheet (row, column, text). Column 1 holds the labels;
# the header row also contains a cell that normalises like the id label and
# an EndDate name, both of which must not disturb marker discovery.
SHEET_FIXED_CELLS = (
    (0, 0, "Query sheet"),
    (2, 1, "Header"),
    (2, 2, "O-OrderDate"),
    (2, 3, " O_CustKey "),
    (2, 4, "o_totalprice"),
    (2, 5, "NULL"),
    (2, 6, "rate usd"),
    (2, 7, "  Voyage ID "),
    (2, 8, "O OrderKey"),
    (2, 9, "EndDate"),
    (3, 1, "StartDate"),
    (4, 1, "EndDate"),
    (5, 1, "note"),
    (6, 1, "Voyage ID"),
    (7, 1, "Voyage ID"),
)
SET_COLUMN_OFFSET = 1  # a segment's first customer stands in column 2
N_ROWS = 8
# Columns of a page; the fixed cells stand on the first.
PAGE_COLUMNS = 1000
# Segments whose first positions may be broadcast.
MAX_BROADCAST_SEGMENTS = 100_000
ROW_START, ROW_END, ROW_NOTE, ROW_ID, ROW_DECOY = 3, 4, 5, 6, 7
# ---------------------------------------------------------------------------


def customer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sheet, nth, start, end, note, id, decoy): what each customer's column
    of its segment's sheet holds, NULL for a blank cell."""
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    ks = k.cast("string")
    year = (F.lit(1995) + F.pmod(F.col("c_nationkey"), F.lit(4))).cast("string")
    year_next = (F.lit(1996) + F.pmod(F.col("c_nationkey"), F.lit(4))).cast("string")
    id_text = (
        F.when(F.pmod(k, F.lit(50)) == 7, F.lit("null"))
        .when(F.pmod(k, F.lit(4)) == 0, F.concat(F.lit(" '"), ks, F.lit("' ")))
        .when(F.pmod(k, F.lit(4)) == 1, F.concat(F.lit("  "), ks, F.lit(" ")))
        .when(F.pmod(k, F.lit(4)) == 2, F.concat(F.lit('"'), ks, F.lit('"')))
        .otherwise(ks)
    )
    start_text = (
        F.when(F.pmod(k, F.lit(5)) == 0, F.concat(year, F.lit("-01-15 00:00")))
        .when(F.pmod(k, F.lit(5)) == 1, F.concat(F.lit("1/15/"), year))
        .when(F.pmod(k, F.lit(5)) == 2, F.concat(F.lit("UTC "), year, F.lit("-01-15")))
        .when(F.pmod(k, F.lit(5)) == 3, F.lit("not a date"))
    )
    end_text = (
        F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("12/31/"), year_next))
        .when(F.pmod(k, F.lit(3)) == 1, F.concat(year_next, F.lit("-06-30T12:00:00Z")))
    )
    placed = with_position(cust, [F.col("c_mktsegment"), F.col("c_custkey")], "pos")
    first, _ = broadcast_if_small(placed.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.min("pos").alias("first")), MAX_BROADCAST_SEGMENTS)
    return placed.join(first, F.col("c_mktsegment").eqNullSafe(F.col("segment"))).select(
        F.col("c_mktsegment").alias("sheet"),
        (F.col("pos") - F.col("first") + 1).alias("nth"),
        start_text.alias("start"),
        end_text.alias("end"),
        F.concat(F.lit("n"), ks).alias("note"),
        id_text.alias("id"),
        F.concat(F.lit("decoy"), ks).alias("decoy"),
    )


def _sheet_text(v):
    """A cell as the sheet reader takes it back: quotes inside are escaped by
    a backslash, the reader's own convention."""
    v = F.coalesce(v, F.lit(""))
    return F.when(v.rlike('[",]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(v)


def write_segment_sheets(spark: SparkSession, sf_dir: str, page_columns: int = PAGE_COLUMNS) -> str:
    """The derived sheets as CSV files ``sheet=<segment>/page=<n>/part-*`` in
    the shared checkpoint folder; returns that folder. A page's row is one
    line, so a page's cells meet in one group."""
    if page_columns <= max(c for _, c, _ in SHEET_FIXED_CELLS):
        raise ValueError("the fixed cells need a wider page")
    rows = {r: [""] * (max([c for r2, c, _ in SHEET_FIXED_CELLS if r2 == r], default=1) + 1) for r in range(N_ROWS)}
    for r, c, v in SHEET_FIXED_CELLS:
        rows[r][c] = v
    filled = {ROW_START: "start", ROW_END: "end", ROW_NOTE: "note", ROW_ID: "id", ROW_DECOY: "decoy"}
    texts = F.struct("nth", *[_sheet_text(F.col(c)).alias(c) for c in filled.values()])
    page = F.floor((F.col("nth") + SET_COLUMN_OFFSET) / page_columns).alias("page")
    pages = customer_texts(spark, sf_dir).groupBy("sheet", page).agg(F.sort_array(F.collect_list(texts)).alias("x"))
    # every sheet has its first page, with the labels, as its first customer stands there

    def line(r: int):
        first = F.col("page") == 0
        if r not in filled:
            # the reader leaves out empty lines
            return F.when(first, F.lit(",".join(rows[r]))).otherwise(F.lit(","))
        cells = F.array_join(F.col("x")[filled[r]], ",")
        return F.when(first, F.concat(F.lit(",".join(rows[r]) + ","), cells)).otherwise(F.concat(cells, F.when(F.size("x") == 1, F.lit(",")).otherwise(F.lit(""))))

    lines = pages.select("sheet", "page", F.posexplode(F.array(*map(line, range(N_ROWS)))).alias("r", "line"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheets-{uuid.uuid4().hex}"
    lines.sortWithinPartitions("sheet", "page", "r").select("sheet", "page", "line").write.partitionBy("sheet", "page").text(path)
    delete_on_exit(spark, path)
    return path


# --- Fixed values -----------------------------------------------------------
# Sheets with filter rows: a customer block each, by the block's number modulo
# four. The columns are those of the header row.
BLOCK_CUSTOMERS = 250
BLOCK_HEADER = ("O-OrderDate", "O_CustKey", "O OrderStatus", "o_orderpriority", "O OrderKey")
# Sheets of one folder: Spark lists folders of one level by a task each.
FOLDER_SHEETS = 64
BLOCK_START = "1996-01-01"  # of every third customer
BLOCK_FILTERS = {
    1: (("", "", "F", "", ""),),
    # the second row asks for the block's first customer
    2: (("", "", "O", "1-%", ""), ("", "{first}", "", "", "")),
    3: (("", "", "", "%LOW%", ""), ("", "", "P", "", "%3"), ("NULL", "", "  ", "", "")),
}
# ---------------------------------------------------------------------------


def write_block_sheets(spark: SparkSession, sf_dir: str) -> str:
    """Sheets ``folder=<n>/sheet=<block>/part-*`` of ``BLOCK_CUSTOMERS``
    customers each, with filter rows; the number of sheets grows with the
    table, no sheet does."""
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    k = F.col("c_custkey")
    block = F.floor(k / BLOCK_CUSTOMERS).cast("long").alias("sheet")
    start = F.when(k % 3 == 0, BLOCK_START).otherwise("")
    cells = cust.groupBy(block).agg(F.sort_array(F.collect_list(F.struct(k.alias("k"), start.alias("s")))).alias("x"))  # a block's
    first = F.col("x")[0]["k"].cast("string")

    def filters(rows):
        return F.array(*[F.replace(F.lit(",Filter," + ",".join(r)), F.lit("{first}"), first) for r in rows])

    chosen = F.array().cast("array<string>")
    for n, rows in BLOCK_FILTERS.items():
        chosen = F.when(F.col("sheet") % len(BLOCK_FILTERS | {0: ()}) == n, filters(rows)).otherwise(chosen)
    lines = F.concat(
        F.array(
            F.lit("Block sheet"),
            F.lit(",Header," + ",".join(BLOCK_HEADER)),
            F.concat(F.lit(",StartDate,"), F.array_join(F.col("x")["s"], ",")),
            F.concat(F.lit(",Voyage ID,"), F.array_join(F.transform(F.col("x")["k"], lambda v: v.cast("string")), ",")),
        ),
        chosen,
    )
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheets-{uuid.uuid4().hex}"
    folder = F.floor(F.col("sheet") / FOLDER_SHEETS).alias("folder")
    out = cells.select(folder, "sheet", F.posexplode(lines).alias("r", "line")).sortWithinPartitions("folder", "sheet", "r")
    out.select("folder", "sheet", "line").write.partitionBy("folder", "sheet").text(path)
    delete_on_exit(spark, path)
    return path


def _segment():
    return F.regexp_extract("sheet", "/sheet=([^/]+)/", 1).alias("sheet")


def _left_of(page_columns: int):
    """Columns of the sheet left of a page's."""
    return F.regexp_extract("sheet", "/page=([0-9]+)/", 1).cast("int") * page_columns


def segment_cells(spark: SparkSession, sf_dir: str, page_columns: int = PAGE_COLUMNS) -> DataFrame:
    """(sheet, r, c, v) of the derived sheets, read from their pages."""
    cells = grid_to_cells(read_sheet_grid(spark, write_segment_sheets(spark, sf_dir, page_columns)))
    return cells.select(_segment(), "r", (F.col("c") + _left_of(page_columns)).alias("c"), "v")


def segment_shape(spark: SparkSession, sf_dir: str, page_columns: int = PAGE_COLUMNS) -> DataFrame:
    """(sheet, n_rows, n_cols) of the derived sheets, from their pages'."""
    grid = read_sheet_grid(spark, write_segment_sheets(spark, sf_dir, page_columns))
    pages = sheet_shape(grid_to_cells(grid), grid)
    width = F.when(F.col("n_cols") > 0, F.col("n_cols") + _left_of(page_columns)).otherwise(0)
    return pages.select(_segment(), "n_rows", width.alias("n_cols")).groupBy("sheet").agg(F.max("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"))


# The cells of the derived sheets in DuckDB, used by the oracle queries.
SEGMENT_SHEET_CELLS_SQL = """
fixed(r, c, v) AS (VALUES {fixed_values}),
cust AS (SELECT c_custkey AS k, c_nationkey AS nk, c_mktsegment AS sheet,
                CAST(c_custkey AS VARCHAR) AS ks,
                CAST(1995 + (c_nationkey % 4) AS VARCHAR) AS y,
                CAST(1996 + (c_nationkey % 4) AS VARCHAR) AS y2,
                row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS nth
         FROM customer),
var_cells AS (
  SELECT sheet, {row_id}::BIGINT AS r, CAST(nth + {off} AS INTEGER) AS c,
         CASE WHEN k % 50 = 7 THEN 'null'
              WHEN k % 4 = 0 THEN ' ''' || ks || ''' '
              WHEN k % 4 = 1 THEN '  ' || ks || ' '
              WHEN k % 4 = 2 THEN '"' || ks || '"'
              ELSE ks END AS v FROM cust
  UNION ALL
  SELECT sheet, {row_start}, CAST(nth + {off} AS INTEGER),
         CASE WHEN k % 5 = 0 THEN y || '-01-15 00:00'
              WHEN k % 5 = 1 THEN '1/15/' || y
              WHEN k % 5 = 2 THEN 'UTC ' || y || '-01-15'
              WHEN k % 5 = 3 THEN 'not a date' END FROM cust
  UNION ALL
  SELECT sheet, {row_end}, CAST(nth + {off} AS INTEGER),
         CASE WHEN k % 3 = 0 THEN '12/31/' || y2
              WHEN k % 3 = 1 THEN y2 || '-06-30T12:00:00Z' END FROM cust
  UNION ALL
  SELECT sheet, {row_note}, CAST(nth + {off} AS INTEGER), 'n' || ks FROM cust
  UNION ALL
  SELECT sheet, {row_decoy}, CAST(nth + {off} AS INTEGER), 'decoy' || ks FROM cust
),
cells AS (
  SELECT s.sheet, f.r::BIGINT AS r, f.c::INTEGER AS c, f.v
  FROM (SELECT DISTINCT c_mktsegment AS sheet FROM customer) s CROSS JOIN fixed f
  UNION ALL
  SELECT sheet, r, c, v FROM var_cells WHERE v IS NOT NULL
)
""".format(
    fixed_values=", ".join("({}, {}, '{}')".format(r, c, v.replace("'", "''")) for r, c, v in SHEET_FIXED_CELLS),
    off=SET_COLUMN_OFFSET,
    row_id=ROW_ID,
    row_start=ROW_START,
    row_end=ROW_END,
    row_note=ROW_NOTE,
    row_decoy=ROW_DECOY,
)
