"""Parameter sets from the cell table.

Each sheet column right of the id marker is one set: its id is the cell in
the id row, its bounds are the cells of the same column in the StartDate /
EndDate rows. The alignment is a ``groupBy(sheet, c)`` over the cells of the
three marker rows – a partial aggregate, so even one huge sheet spreads over
all tasks by column. The set key is ``(sheet, c)``; ``c`` also gives the set
order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_bound
from ..functions.text import clean_id, is_missing

PARAM_COLUMNS = ("sheet", "c", "id", "start", "end")


def raw_param_cells(cells: DataFrame, mk: DataFrame, broadcast_mk: bool = False, ascii_only: bool = False) -> DataFrame:
    """(sheet, c, id, start, end, id_raw, start_raw, end_raw, start_r, end_r)
    for every column right of the id marker.

    The cells of the three marker rows are cleaned and parsed where they are
    read (before the shuffle, in parallel over the cell partitions); the
    ``groupBy(sheet, c)`` only gathers the three values of a column. ``mk``
    (one row per sheet) is broadcast when the caller has checked the sheet
    count.
    """
    m = mk.select("sheet", "id_r", "id_c", "start_r", "end_r")
    m = F.broadcast(m) if broadcast_mk else m
    r, v = F.col("r"), F.col("v")
    is_id, is_start, is_end = r == F.col("id_r"), r == F.col("start_r"), r == F.col("end_r")
    x = cells.join(m, "sheet").where((F.col("c") > F.col("id_c")) & (is_id | is_start | is_end))
    x = x.select(
        "sheet",
        "c",
        F.when(is_id, v).alias("id_raw"),
        F.when(is_start, v).alias("start_raw"),
        F.when(is_end, v).alias("end_raw"),
        F.when(is_id, clean_id(v, ascii_only)).alias("id"),
        F.when(is_start, parse_bound(v)).alias("start"),
        F.when(is_end, parse_bound(v, is_end=True)).alias("end"),
        "start_r",
        "end_r",
    )
    return x.groupBy("sheet", "c").agg(
        *[F.max(c).alias(c) for c in ("id", "start", "end", "id_raw", "start_raw", "end_raw", "start_r", "end_r")]
    )


def clean_params(raw: DataFrame) -> DataFrame:
    """Sets only: columns whose id cell is missing give no set. A missing or
    unreadable bound is NULL, which means open."""
    return raw.where(F.col("id").isNotNull())


def param_sets(cells: DataFrame, mk: DataFrame, ascii_only: bool = False, broadcast_mk: bool = False) -> DataFrame:
    """(sheet, c, id, start, end)."""
    return clean_params(raw_param_cells(cells, mk, broadcast_mk, ascii_only)).select(*PARAM_COLUMNS)


def param_errors(cells: DataFrame, mk: DataFrame, ascii_only: bool = False, broadcast_mk: bool = False) -> DataFrame:
    """(sheet, r, c, v): filled bound cells of a set that could not be read.

    Such a bound is treated as open, which silently widens the set; this
    table makes that visible (and ``on_bad_bound='error'`` refuses the run).
    """
    p = clean_params(raw_param_cells(cells, mk, broadcast_mk, ascii_only))
    bad_start = p.where(~is_missing("start_raw") & F.col("start").isNull()).select(
        "sheet", F.col("start_r").alias("r"), "c", F.col("start_raw").alias("v")
    )
    bad_end = p.where(~is_missing("end_raw") & F.col("end").isNull()).select(
        "sheet", F.col("end_r").alias("r"), "c", F.col("end_raw").alias("v")
    )
    return bad_start.unionByName(bad_end)
