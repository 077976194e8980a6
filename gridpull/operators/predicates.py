"""Row predicates of a set and of filter groups.

``or_groups`` builds the filter-row form of a query: every group is a list of
conditions ANDed together, groups are ORed, and the date clause is ANDed
with the whole. Conditions are ``(column, '=', value)`` or
``(column, 'like', pattern)``; both push down to Parquet (EqualTo /
StringContains / StringStartsWith).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projection import column_type


def eq(col: str, value, dtype=None) -> Column:
    """col = value (NULL never matches); the literal takes the column type."""
    lit = F.lit(value) if dtype is None else F.lit(value).try_cast(dtype)
    return F.col(col) == lit


def date_clause(date_col: str, start=None, end=None) -> Column:
    """BETWEEN / >= / <= depending on which bound is given (inclusive)."""
    d = F.col(date_col)
    c = F.lit(True)
    if start is not None:
        c = c & (d >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        c = c & (d <= F.lit(end).cast("timestamp_ntz"))
    return c


def _cond(df: DataFrame | None, col: str, op: str, value) -> Column:
    op = op.lower()
    if op in ("=", "eq"):
        dtype = column_type(df, col) if df is not None else None
        return eq(col, value, dtype)
    if op == "like":
        return F.col(col).like(str(value))
    raise ValueError(f"unsupported operator {op!r}")


def or_groups(
    groups: Sequence[Sequence[tuple[str, str, object]]],
    date_col: str | None = None,
    start=None,
    end=None,
    df: DataFrame | None = None,
) -> Column:
    """(g1 OR g2 OR …) AND date clause; each group is an AND of conditions.
    No groups -> only the date clause."""
    parts = []
    for g in groups:
        if g:
            parts.append(reduce(lambda a, b: a & b, [_cond(df, c, op, v) for c, op, v in g]))
    pred = reduce(lambda a, b: a | b, parts) if parts else F.lit(True)
    if date_col is not None:
        pred = pred & date_clause(date_col, start, end)
    return pred
