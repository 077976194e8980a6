"""Filter rows of a sheet: predicates as data.

A row labelled ``Filter`` (in the Header label's column) is one group of
conditions. A filled cell of it is a condition on the column that the header
row names above it: LIKE where the cell holds a ``%``, equality in the
column's type otherwise. Conditions of a row are ANDed, rows are ORed, and the
whole is ANDed with the parameter sets. Cells under no name, or under a bound
name (StartDate / EndDate), are notes; a row without conditions is no group; a
sheet without groups filters nothing.

``filter_atoms``   the relation (sheet, g, name, op, value), one row each.
``filter_index``   per sheet: equality atoms as a map from (column, value) to
                   the groups that ask for it, LIKE atoms as a list, and how
                   many atoms each group needs.
``filter_rows``    rows that satisfy a group of their sheet. A row looks up
                   its own values, so its cost follows the atoms it meets and
                   not the number of groups; a group holds when all its atoms
                   were met.
``filter_groups``  the groups of one sheet as literals, which reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Labels
from ..functions.text import is_missing, label_keys, norm_label, strip_ws
from .markers import header_names
from .projection import column_type
from .sizing import broadcast_if_small, materialize, take_at_most

#: Groups of one sheet that become literals of its scan hold at most this many conditions.
MAX_LITERAL_ATOMS = 500
#: Up to so many filter rows are broadcast to the cells.
MAX_BROADCAST_GROUPS = 100_000
_BETWEEN = "\x00"
_PLAIN_LIKE = r"(?s)^(%?)([^%_\\]*)(%?)\z"


def filter_atoms(cells: DataFrame, mk: DataFrame, labels: Labels = Labels(), broadcast_mk: bool = False, ascii_only: bool = False) -> DataFrame:
    """(sheet, g, name, op, value): the distinct conditions of the filter
    rows; g is the row."""
    m = mk.where("has_filter").select("sheet", "header_r", "header_c")
    m = F.broadcast(m) if broadcast_mk else m
    other = F.col("r") != F.col("header_r")
    # A condition on both sides stays above the join, so no cell of another column is normalised.
    label = norm_label(F.when(other, F.col("v"))).isin(label_keys((labels.filter,)))
    rows = cells.join(m, "sheet").where((F.col("c") == F.col("header_c")) & other & label).select("sheet", F.col("r").alias("g"), "header_c").distinct()
    rows, _ = broadcast_if_small(materialize(rows), MAX_BROADCAST_GROUPS)
    right = F.col("c") > F.col("header_c")
    filled = cells.withColumnRenamed("r", "g").join(rows, ["sheet", "g"]).where(right & ~is_missing(F.when(right, F.col("v"))))
    filled = filled.select("sheet", "g", "c", strip_ws("v").alias("value"))
    names = header_names(cells, mk.where("has_filter"), labels, True, broadcast_mk, ascii_only)
    op = F.when(F.col("value").contains("%"), F.lit("like")).otherwise(F.lit("="))
    return filled.join(names, ["sheet", "c"]).select("sheet", "g", F.lower("name").alias("name"), op.alias("op"), "value").distinct()


def _value_text(c: Column, dtype: T.DataType) -> Column:
    """One text for equal values of a type."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = c + F.lit(0.0).cast(dtype)  # -0.0 equals 0.0
    return c.cast("string")


def filter_errors(atoms: DataFrame, fact: DataFrame) -> DataFrame:
    """(sheet, error) of sheets with a condition on a column that the table lacks."""
    have = [c.lower() for c in fact.columns]
    bad = atoms.where(~F.col("name").isin(have)).groupBy("sheet").agg(F.min("name").alias("n"))
    return bad.select("sheet", F.format_string("filter on a column that the table lacks: '%s'", "n").alias("error"))


def filter_columns(atoms: DataFrame, fact: DataFrame) -> list[str]:
    """Fact columns with conditions: at most the table's."""
    asked = {r["name"] for r in atoms.select("name").where(F.col("name").isin([c.lower() for c in fact.columns])).distinct().collect()}
    return [c for c in fact.columns if c.lower() in asked]


def filter_index(atoms: DataFrame, fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(sheet, eq map<string, array<int>>, likes array<struct<name, value, g,
    kind, part>>, need map<int, int>). A pattern with ``%`` at its ends only is
    a search for ``part``, which needs no regular expression a row."""
    typed = F.lit(None).cast("string")
    for c in columns:
        dtype = column_type(fact, c)
        typed = F.when(F.col("name") == c.lower(), _value_text(F.col("value").try_cast(dtype), dtype)).otherwise(typed)
    g = F.col("g").cast("int")
    x = atoms.select("sheet", g.alias("g"), "name", "op", F.when(F.col("op") == "=", typed).otherwise(F.col("value")).alias("value"))
    # a value that is none of the column's type meets no row; its group still needs it
    need = x.groupBy("sheet", "g").agg(F.count("*").cast("int").alias("n"))
    need = need.groupBy("sheet").agg(F.map_from_entries(F.collect_list(F.struct("g", "n"))).alias("need"))
    eq = x.where("op = '=' and value is not null").groupBy("sheet", F.concat_ws(_BETWEEN, "name", "value").alias("k")).agg(F.collect_list("g").alias("gs"))
    eq = eq.groupBy("sheet").agg(F.map_from_entries(F.collect_list(F.struct("k", "gs"))).alias("eq"))
    part = F.regexp_extract("value", _PLAIN_LIKE, 2)
    ends = F.concat(F.regexp_extract("value", _PLAIN_LIKE, 1), F.lit("x"), F.regexp_extract("value", _PLAIN_LIKE, 3))
    kind = F.when(F.col("value").rlike(_PLAIN_LIKE), ends).otherwise(F.lit("like"))
    likes = x.where("op = 'like'").groupBy("sheet").agg(F.collect_list(F.struct("name", "value", "g", kind.alias("kind"), part.alias("part"))).alias("likes"))
    return need.join(eq, "sheet", "left").join(likes, "sheet", "left").select("sheet", "eq", "likes", "need")


def filter_rows(rows: DataFrame, index: DataFrame, columns: Sequence[str], max_sheets: int) -> DataFrame:
    """Rows of ``rows`` (with a ``sheet``) that satisfy a group of their
    sheet, or whose sheet has none."""
    index = materialize(index)
    side, _ = broadcast_if_small(index.select(F.col("sheet").alias("_sheet"), F.col("eq").alias("_eq"), F.col("likes").alias("_likes"), F.col("need").alias("_need")), max_sheets)
    texts = {c.lower(): _value_text(F.col(f"`{c}`"), column_type(rows, c)) for c in columns}
    none = F.array().cast("array<int>")

    def fits(x, text: Column) -> Column:
        kinds = F.when(x["kind"] == "x%", F.startswith(text, x["part"])).when(x["kind"] == "%x", F.endswith(text, x["part"]))
        kinds = kinds.when(x["kind"] == "%x%", F.contains(text, x["part"])).when(x["kind"] == "x", text == x["part"])
        return kinds.otherwise(F.like(text, x["value"]))

    def hits(v: Column) -> Column:
        met = [F.coalesce(F.try_element_at("_eq", F.concat(F.lit(n + _BETWEEN), F.try_element_at(v, F.lit(n)))), none) for n in texts]
        liked = F.filter("_likes", lambda x: fits(x, F.try_element_at(v, x["name"])))
        return F.concat(*met, F.coalesce(F.transform(liked, lambda x: x["g"]), none))

    # A group holds when as many atoms were met as it needs. What stands in an
    # array of one is computed once for a row, not for each use below it.
    values = F.map_from_arrays(F.array(*[F.lit(n) for n in texts]), F.array(*texts.values()))
    full = lambda h: F.exists(F.array_distinct(h), lambda g: F.size(F.filter(h, lambda x: x == g)) == F.try_element_at("_need", g))
    holds = F.exists(F.array(values), lambda v: F.exists(F.array(hits(v)), full))
    return rows.join(side, F.col("sheet") == F.col("_sheet"), "left").where(F.col("_need").isNull() | holds).select(*rows.columns)


def filter_groups(atoms: DataFrame) -> list[list[tuple[str, str, str]]] | None:
    """One sheet's groups, in row order; None if they hold too many
    conditions for literals."""
    rows = take_at_most(atoms.select("g", "name", "op", "value"), MAX_LITERAL_ATOMS)
    if rows is None:
        return None
    groups: dict[int, list] = {}
    for r in sorted(rows):
        groups.setdefault(r["g"], []).append((r["name"], r["op"], r["value"]))
    return list(groups.values())
