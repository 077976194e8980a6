"""Keyed de-duplication with a deterministic survivor.

``dropDuplicates`` keeps an arbitrary row per key; the sheet workflow kept
"the first one returned", which is only defined up to the server's order.
Here the survivor is the smallest row under an explicit total order
(``order``), so results are reproducible run to run and cluster to cluster.

Plan: ``row_number() over (partition by keys order by …) = 1`` is planned by
Spark as WindowGroupLimit (partial, before the shuffle) + Window; the partial
step keeps only the first row per key in every map task, so a hot key sends
at most one row per task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def orderable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = {c.lower() for c in exclude}
    return [f.name for f in df.schema.fields if f.name.lower() not in ex and not isinstance(f.dataType, _UNORDERABLE)]


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (default: all other
    orderable columns ascending, NULLs first). NULL key values form one group."""
    order = list(order) if order else orderable_columns(df, keys)
    if not order:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_keys(df: DataFrame, id_col: str, date_col: str | None, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Key choice of the sheet workflow: (id, date) when both exist, id alone
    when there is no date column, the full row otherwise."""
    have = {c.lower(): c for c in df.columns}
    keys = [have[k.lower()] for k in (id_col, date_col) if k and k.lower() in have]
    if have.get((id_col or "").lower()) not in keys:
        return df.distinct()
    return dedup_first(df, keys, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (hash aggregate with map-side partial distinct)."""
    return df.distinct()
