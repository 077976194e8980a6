"""Fact-table sources: Parquet, catalog tables and JDBC.

Whatever the source, the result is a DataFrame; filters and the column list
are applied afterwards with the DataFrame API and Catalyst pushes them into
the scan (Parquet: ``PushedFilters`` / ``ReadSchema``; JDBC: WHERE clause and
column list).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """Catalog table addressed as ``schema.table`` (or a temp view)."""
    return spark.table(f"{schema}.{name}" if schema else name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """JDBC table. With ``predicates`` every predicate becomes one partition
    (e.g. one per parameter set, see :func:`set_predicates_sql`), so the
    database answers the sets in parallel. Needs the driver jar on the
    classpath; not exercised offline."""
    props = dict(properties or {})
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    return spark.read.jdbc(url, table, properties=props)


def _sql_text(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def set_predicates_sql(sets: Sequence[dict], id_col: str, date_col: str) -> list[str]:
    """One SQL WHERE fragment per set (for JDBC partitioning); bounds are
    ISO texts or None (open)."""
    out = []
    for s in sets:
        terms = [f'"{id_col}" = {_sql_text(s["id"])}']
        if s.get("start"):
            terms.append(f'"{date_col}" >= {_sql_text(s["start"])}')
        if s.get("end"):
            terms.append(f'"{date_col}" <= {_sql_text(s["end"])}')
        out.append(" AND ".join(terms))
    return out


def read_jdbc_for_sets(
    spark: SparkSession,
    url: str,
    table: str,
    params,
    id_col: str,
    date_col: str,
    properties: dict | None = None,
    partitions: int = 50,
    max_sets: int = 100_000,
):
    """Fact rows of parameter sets straight from a database, as one job of up
    to ``partitions`` parallel queries; more sets share a query's WHERE.

    ``params`` is a (id, start, end) DataFrame. The sets are query text, so
    they come to the driver, counted: beyond ``max_sets`` read the table with
    column partitioning and use the set join. No sets give an empty frame.
    Overlapping sets may return a row once per query, which the set join and
    de-dup absorb.
    """
    from ..functions.dates import iso_text
    from ..operators.sizing import take_at_most

    rows = take_at_most(
        params.select("id", iso_text("start").alias("start"), iso_text("end").alias("end")).distinct(), max_sets
    )
    if rows is None:
        raise ValueError(f"more than {max_sets} sets: use a partitioned table read and the set join")
    preds = grouped_predicates(set_predicates_sql([r.asDict() for r in rows], id_col, date_col), partitions)
    return read_jdbc(spark, url, table, properties, preds)


def grouped_predicates(preds: Sequence[str], partitions: int) -> list[str]:
    """At most ``partitions`` WHERE fragments that cover all ``preds``; one
    that is never true when there are none."""
    if not preds:
        return ["1 = 0"]
    if len(preds) <= partitions:
        return list(preds)
    return [" OR ".join(f"({p})" for p in preds[i::partitions]) for i in range(partitions)]
