"""Marker discovery on the cell table.

* ``marker_scan``  columns holding an anchor label (candidate label columns).
* ``find_markers`` first cell, in row-major order, of each label inside the
  candidate columns – ``min(struct(r, c))`` per (sheet, label).
* ``marker_table`` one row per sheet with every marker position.
* ``header_names`` output column names right of the Header marker.

Restricting the search to candidate columns keeps a header cell such as
``Voyage ID`` (which normalises like the id label) from being taken as the
id marker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Labels
from ..functions.text import is_missing, label_keys, norm_label, sanitize_name

ROLES = ("header", "start", "end", "id")
NON_ASCII = r"[^\x00-\x7F]"


def marker_scan(cells: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """(sheet, c): distinct columns that contain an anchor label."""
    return cells.where(norm_label("v").isin(label_keys(labels.anchors))).select("sheet", "c").distinct()


def marker_table(cells: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """One row per sheet: header_r, header_c, start_r, start_c, end_r, end_c,
    id_r, id_c – the first cell (row-major) of each label inside the
    candidate label columns, NULL when a label is absent – whether any cell is
    non-ASCII (only then does text need the NFKC step), and whether any reads
    like the filter rows' label.

    One scan of the cells, folded per (sheet, column) and then per sheet: two
    partial aggregates. A sheet without any label still gets its row.
    """
    n = F.col("n")
    keyed = cells.select("sheet", "r", "c", norm_label("v").alias("n"), F.col("v").rlike(NON_ASCII).alias("_wide"))
    rc = F.struct("r", "c")
    per_col = keyed.groupBy("sheet", "c").agg(
        F.max(n.isin(label_keys(labels.anchors))).alias("_anchor"),
        F.max("_wide").alias("_wide"),
        F.max(n.isin(label_keys((labels.filter,)))).alias("_filter"),
        *[F.min(F.when(n == key, rc)).alias(role) for role, key in zip(labels.as_dict(), label_keys(labels.as_dict().values()))],
    )
    per_sheet = per_col.groupBy("sheet").agg(
        F.max("_wide").alias("non_ascii"),
        F.max("_filter").alias("has_filter"),
        *[F.min(F.when(F.col("_anchor"), F.col(role))).alias(role) for role in ROLES],
    )
    cols = []
    for role in ROLES:
        cols += [F.col(f"{role}.r").alias(f"{role}_r"), F.col(f"{role}.c").alias(f"{role}_c")]
    return per_sheet.select("sheet", *cols, "non_ascii", F.coalesce("has_filter", F.lit(False)).alias("has_filter"))


def find_markers(cells: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """(sheet, role, r, c): first hit of each label in the candidate columns."""
    mk = marker_table(cells, labels)
    stacked = F.explode(
        F.array(*[F.struct(F.lit(role).alias("role"), F.col(f"{role}_r").alias("r"), F.col(f"{role}_c").alias("c")) for role in ROLES])
    )
    return mk.select("sheet", stacked.alias("m")).select("sheet", "m.role", "m.r", "m.c").where(F.col("r").isNotNull())


def lacks(label: str) -> str:
    """What is said of a sheet without a required label."""
    return f"no cell of the label columns reads {label!r}"


def no_names(label: str) -> str:
    """What is said of a sheet whose header row is empty."""
    return f"nothing stands right of {label!r}"


def marker_errors(mk: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """(sheet, error) for sheets lacking a required marker."""
    return mk.select(
        "sheet",
        F.when(F.col("header_r").isNull(), F.lit(lacks(labels.header)))
        .when(F.col("id_r").isNull(), F.lit(lacks(labels.id)))
        .alias("error"),
    ).where(F.col("error").isNotNull())


def header_names(
    cells: DataFrame,
    mk: DataFrame,
    labels: Labels = Labels(),
    omit_bound_headers: bool = True,
    broadcast_mk: bool = False,
    ascii_only: bool = False,
) -> DataFrame:
    """(sheet, c, name): sanitized names right of the Header marker, in column order.

    ``mk`` has one row per sheet; callers that have checked the sheet count
    pass ``broadcast_mk``. With ``omit_bound_headers`` StartDate /
    EndDate names are left out, as they are query parameters rather than
    table columns.
    """
    m = mk.select("sheet", "header_r", "header_c")
    # Conditions on both sides (but no equality, which is carried over to one)
    # stay above the join, so no cell of another row is cleaned.
    v = F.when(F.col("c") > F.col("header_c"), F.col("v"))
    h = (
        cells.join(F.broadcast(m) if broadcast_mk else m, "sheet")
        .where((F.col("r") == F.col("header_r")) & (F.col("c") > F.col("header_c")) & ~is_missing(v))
        .select("sheet", "c", sanitize_name(v, nfkc_text=not ascii_only).alias("name"))
    )
    if omit_bound_headers:
        h = h.where(~norm_label("name").isin(label_keys((labels.start, labels.end))))
    return h
