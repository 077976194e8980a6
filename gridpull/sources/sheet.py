"""Parameter sheets: headerless CSV grids -> long cell tables.

Sheets are read as lines of text, split by Spark like any text: a huge file is
several byte ranges, a folder of small ones a few tasks. A quoted field may
hold line breaks, so a record can be several lines, even across a range's
border. What a line does to the state "inside quotes" is a function of two
values; the last line that fixes the state, and the swaps since, give the
state before any line. Each range is one window, and what it needs from the
ranges before it is one row a range.

A record is cut into fields by expressions, without a schema of columns, so a
sheet may have any width, and nothing is typed (``007`` stays ``007``, dates
stay text). The rules are those of Spark's CSV reader: ``"`` quotes a field
that it begins, ``\\`` escapes a quote or itself inside, blanks may follow the
closing quote, quotes elsewhere are plain characters, empty lines are left
out, empty fields are missing.

The (decoded) file path is the ``sheet`` key carried through every later step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small, materialize

MAX_BROADCAST_RANGES = 100_000
MAX_BROADCAST_RECORDS = 1_000_000

# --- Fixed patterns of the CSV rules -----------------------------------------
_INSIDE = r'[^"\\]*+(?:\\.[^"\\]*+)*+'  # of quotes, up to one that is not escaped
_CLOSED = rf'"{_INSIDE}"++[ \t]*+'
_OPEN = rf'"{_INSIDE}\\?+'
# a field, from the delimiter before it; quotes that do not end it are plain
FIELD = rf"(?s),(?:{_CLOSED}(?=,|\z)|{_OPEN}\z|[^,]*+)"
# quoted fields that end on the line, well-formed or not
QUOTED_ON_LINE = rf'(?s),"{_INSIDE}"[^,]*+'
# the rest of a quoted field that began on an earlier line
REST_OF_QUOTED = rf'(?s)^{_INSIDE}"[^,]*+'
# -----------------------------------------------------------------------------


def sheet_key() -> Column:
    """The file's path with %-escapes decoded ('+' is a plain character)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def fields(record: Column) -> Column:
    """A record's fields as array<string>; empty fields are NULL."""
    quote = F.contains(record, F.lit('"'))

    def value(with_comma: Column) -> Column:
        f = F.substr(with_comma, F.lit(2))
        body = F.when(f.rlike(rf"(?s)^{_CLOSED}\z"), F.regexp_replace(f, r'(?s)^"(.*)"[ \t]*\z', "$1"))
        body = body.when(f.rlike(rf"(?s)^{_OPEN}\z"), F.substr(f, F.lit(2)))
        return F.when(f.startswith('"'), F.coalesce(F.regexp_replace(body, r'\\(["\\])', "$1"), f)).otherwise(f)

    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(0)), value)
    plain = F.split(record, ",", -1)
    return F.transform(F.when(quote, quoted).otherwise(plain), lambda v: F.nullif(v, F.lit("")))


def opens_quotes(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside."""
    return F.contains(F.regexp_replace(F.concat(F.lit(","), line), QUOTED_ON_LINE, ""), F.lit(',"'))


def stays_quoted(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside."""
    after = F.regexp_replace(line, REST_OF_QUOTED, "")
    ends = F.contains(F.regexp_replace(after, QUOTED_ON_LINE, ""), F.lit(',"'))
    return F.when(line.rlike(REST_OF_QUOTED), ends).otherwise(F.lit(True))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(sheet, b, k, line): byte range and place in it of every line."""
    return spark.read.text(list(paths)).select(
        sheet_key().alias("sheet"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("k"), F.col("value").alias("line")
    )


def _quote_states(lines: DataFrame) -> DataFrame:
    """``lines`` with ``inside``: whether each begins inside quotes."""
    opens, stays = F.col("opens"), F.col("stays")
    x = lines.withColumn("opens", opens_quotes(F.col("line"))).withColumn("stays", stays_quoted(F.col("line")))
    own = Window.partitionBy("sheet", "b").orderBy("k")
    before, upto = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("swap", (opens & ~stays).cast("int")).withColumn("swaps", F.sum("swap").over(upto))
    fixed = F.when(opens == stays, F.struct(opens.cast("int").alias("to"), F.col("swaps").alias("at")))
    x = x.withColumn("fixed", fixed)
    x = x.withColumn("last", F.last("fixed", ignorenulls=True).over(before)).withColumn("done", F.coalesce(F.sum("swap").over(before), F.lit(0)))
    x = materialize(x.drop("opens", "stays"))
    # what a whole range does: the state it fixes, if any, and its swaps since
    ranges = x.groupBy("sheet", "b").agg(F.max_by("fixed", F.when(F.col("fixed").isNotNull(), F.col("k"))).alias("f"), F.sum("swap").alias("s"))
    after = F.when(F.col("f").isNotNull(), F.struct(F.pmod(F.col("f.to") + F.col("s") - F.col("f.at"), F.lit(2)).alias("to"), F.col("total").alias("at")))
    by_file = Window.partitionBy("sheet").orderBy("b")  # a row a range
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("total", F.sum("s").over(by_file.rowsBetween(Window.unboundedPreceding, 0))).withColumn("after", after)
    ranges = ranges.withColumn("l", F.last("after", ignorenulls=True).over(earlier)).withColumn("so_far", F.coalesce(F.sum("s").over(earlier), F.lit(0)))
    begin = F.pmod(F.coalesce(F.col("l.to"), F.lit(0)) + F.col("so_far") - F.coalesce(F.col("l.at"), F.lit(0)), F.lit(2))
    side, _ = broadcast_if_small(materialize(ranges.select("sheet", "b", begin.alias("begin"))), MAX_BROADCAST_RANGES)
    here = F.coalesce(F.col("last.to"), F.col("begin")) + F.col("done") - F.coalesce(F.col("last.at"), F.lit(0))
    return x.join(side, ["sheet", "b"]).select(*lines.columns, (F.pmod(here, F.lit(2)) == 1).alias("inside"))


def _numbered(lines: DataFrame, ranges: bool) -> DataFrame:
    """(sheet, r, b, k, line, inside): the record each line belongs to."""
    lines = lines.where("inside or line <> ''")
    begun = F.sum((~F.col("inside")).cast("long")).over(Window.partitionBy("sheet", "b").orderBy("k"))
    x = lines.select("*", (begun - 1).alias("r"))
    if ranges:
        per = lines.groupBy("sheet", "b").agg(F.sum((~F.col("inside")).cast("long")).alias("n"))
        earlier = Window.partitionBy("sheet").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        side, _ = broadcast_if_small(materialize(per.select("sheet", "b", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("off"))), MAX_BROADCAST_RANGES)
        x = x.join(side, ["sheet", "b"]).withColumn("r", F.col("r") + F.col("off"))
    return x.select("sheet", "r", "b", "k", "line", "inside")


def _numbered_ranges(lines: DataFrame) -> DataFrame:
    """(sheet, r, line): the record each line is, where no field holds a line
    break. A range is one task's, whose lines have consecutive numbers, so
    what a line needs of the others is one row a range; no range is sorted."""
    k = F.monotonically_increasing_id().alias("k")
    x = materialize(lines.where("line <> ''").select("sheet", "b", k, "line"))
    per = x.groupBy("sheet", "b").agg(F.min("k").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("sheet").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    off = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    side, _ = broadcast_if_small(materialize(per.select("sheet", "b", off.alias("off"))), MAX_BROADCAST_RANGES)
    return x.join(side, ["sheet", "b"]).select("sheet", (F.col("k") + F.col("off")).alias("r"), "line")


def read_sheet_grid(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(sheet, r, row array<string>) – one row per CSV record."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines(spark, paths)
    # Usually no quoted field holds a line break, and no file is several ranges.
    seen = lines.agg(F.max(F.contains("line", F.lit('"')) & opens_quotes(F.col("line"))).alias("opens"), F.max("b").alias("b")).first()
    ranges = bool(seen["b"])
    if not seen["opens"]:
        flat = _numbered_ranges(lines) if ranges else _numbered(lines.withColumn("inside", F.lit(False)), False)
        return flat.select("sheet", "r", fields(F.col("line")).alias("row"))
    x = materialize(_numbered(_quote_states(lines), ranges))
    broken, _ = broadcast_if_small(x.where("inside").select("sheet", "r").distinct(), MAX_BROADCAST_RECORDS)
    one = x.join(broken, ["sheet", "r"], "left_anti").select("sheet", "r", "line")
    parts = F.array_sort(F.collect_list(F.struct("b", "k", "line")))  # one record's lines
    many = x.join(broken, ["sheet", "r"], "left_semi").groupBy("sheet", "r").agg(F.array_join(parts["line"], "\n").alias("line"))
    return one.unionByName(many).select("sheet", "r", fields(F.col("line")).alias("row"))


def grid_to_cells(grid: DataFrame) -> DataFrame:
    """Grid -> cells (sheet, r, c, v); blank cells are not materialised."""
    cells = grid.select("sheet", "r", F.posexplode("row").alias("c", "v")).where(F.col("v").isNotNull())
    # A spreadsheet export may start with a UTF-8 byte-order mark.
    v = F.when((F.col("r") == 0) & (F.col("c") == 0), F.regexp_replace("v", "^﻿", "")).otherwise(F.col("v"))
    return cells.select("sheet", "r", F.col("c").cast("int").alias("c"), v.alias("v"))


def read_sheet_cells(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Sheets on disk -> cells (sheet, r, c, v)."""
    return grid_to_cells(read_sheet_grid(spark, paths))


def sheet_shape(cells: DataFrame, grid: DataFrame | None = None) -> DataFrame:
    """(sheet, n_rows, n_cols): rows read and width up to the last filled column.

    With only cells at hand, trailing all-blank rows are not counted.
    """
    width = cells.groupBy("sheet").agg(
        (F.max("c") + 1).alias("n_cols"), (F.max("r") + 1).alias("_rows_from_cells")
    )
    if grid is None:
        return width.select("sheet", F.col("_rows_from_cells").alias("n_rows"), "n_cols")
    rows = grid.groupBy("sheet").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(width, "sheet", "left").select(
        "sheet", "n_rows", F.coalesce("n_cols", F.lit(0)).alias("n_cols")
    )
