"""Result order, pages and probes.

The final order is date ascending then id ascending, NULL / unreadable dates
last. After (id, date) de-duplication that key is already a total order, so
Spark's range-partitioned sort splits even a hot date across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PAGE_SIZE, PROBE_LIMIT
from .projection import column_type
from .sizing import broadcast_if_small, materialize

MAX_BROADCAST_PARTITIONS = 1_000_000


def result_order(date_col: str | None, id_col: str | None, extra: Sequence[str] = ()) -> list[Column]:
    out = []
    if date_col:
        out.append(F.col(date_col).asc_nulls_last())
        if id_col:
            out.append(F.col(id_col).asc_nulls_last())
    out.extend(F.col(c).asc_nulls_first() for c in extra)
    return out


def sort_result(df: DataFrame, date_col: str | None, id_col: str | None, extra: Sequence[str] = ()) -> DataFrame:
    """Date ascending (NULLs last), then id ascending; no date column -> no sort."""
    have = {c.lower(): c for c in df.columns}
    order = result_order(have.get((date_col or "").lower()), have.get((id_col or "").lower()), extra)
    return df.orderBy(*order) if order else df


def fetch_order(date_col: str, extra: Sequence[str] = ()) -> list[Column]:
    """Per-set fetch order: date descending, NULLs last."""
    return [F.col(date_col).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in extra]]


def sort_desc_nulls_last(df: DataFrame, date_col: str, extra: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*fetch_order(date_col, extra))


def with_position(df: DataFrame, order: Sequence[Column] = (), name: str = "pos") -> DataFrame:
    """Attach the 1-based position of each row under ``order`` without a
    single-partition window; without ``order`` the frame is sorted already.

    The frame is range-sorted once and each row records its partition and
    its index inside the partition; that is written as a table in the shared
    checkpoint folder (lineage cut, survives executor loss). Per-partition
    row counts (one row per partition) give each partition's offset.
    """
    sorted_df = (df.orderBy(*order) if order else df).select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    sorted_df = materialize(sorted_df)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = broadcast_if_small(counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")), MAX_BROADCAST_PARTITIONS)
    low_bits = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return sorted_df.join(offsets, "_pid").select(
        *[c for c in df.columns], (F.col("_off") + low_bits + 1).cast("long").alias(name)
    )


# Up to this many leading rows a page is a top-k (each task keeps at most
# this many rows); deeper pages go through distributed positions.
TOP_K_PAGE_DEPTH = 100_000


def page(df: DataFrame, order: Sequence[Column], page_no: int, size: int = PAGE_SIZE) -> DataFrame:
    """Rows ``page_no*size .. page_no*size+size-1`` under a total ``order``
    (an offset page is only stable when the order is total).

    Shallow pages plan as TakeOrderedAndProject; a deep page would make
    every task keep offset+size rows, so it filters positions from
    :func:`with_position` instead."""
    lo = page_no * size
    if lo + size <= TOP_K_PAGE_DEPTH:
        return df.orderBy(*order).offset(lo).limit(size)
    pos = with_position(df, order, "_pos")
    return pos.where((F.col("_pos") > lo) & (F.col("_pos") <= lo + size)).drop("_pos")


def probe_limit(fact: DataFrame, id_col: str, id_value, order: Sequence[Column], n: int = PROBE_LIMIT) -> DataFrame:
    """First ``n`` rows of one id – the smoke probe, with a defined order."""
    dtype = column_type(fact, id_col)
    return fact.where(F.col(id_col) == F.lit(id_value).try_cast(dtype)).orderBy(*order).limit(n)
