"""Select lists and the final projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SUMMARY_TABLE_DDL


def select_list(header: Sequence[str], id_col: str, date_col: str | None) -> list[str]:
    """Header columns plus the dedup keys (id, date) when not asked for."""
    cols = list(header)
    for must in (id_col, date_col):
        if must and must.lower() not in {c.lower() for c in cols}:
            cols.append(must)
    return cols


def _lookup(df: DataFrame) -> dict[str, str]:
    # Spark resolves column names case-insensitively by default.
    return {c.lower(): c for c in df.columns}


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Data type of ``name`` in ``df``, matched case-insensitively like Spark."""
    by_name = {f.name.lower(): f.dataType for f in df.schema.fields}
    try:
        return by_name[name.lower()]
    except KeyError:
        raise ValueError(f"column {name!r} not in {df.columns}") from None


def project(df: DataFrame, header: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``header`` in order (repeats allowed); a name the frame does
    not have becomes the constant ''. ``keep`` columns (e.g. ``sheet``) lead."""
    have = _lookup(df)
    cols = [F.col(k) for k in keep]
    for name in header:
        src = have.get(name.lower())
        cols.append(F.col(src).alias(name) if src is not None else F.lit("").alias(name))
    return df.select(*cols)


def read_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Prune a fact frame to the columns it has out of ``wanted`` (the scan
    then reads only these)."""
    have = _lookup(df)
    seen, cols = set(), []
    for w in wanted:
        src = have.get(w.lower())
        if src is not None and src not in seen:
            seen.add(src)
            cols.append(src)
    return df.select(*cols)


def schema_for(columns: Sequence[str], full: T.StructType | None = None) -> T.StructType:
    """The declared fields (of the summary table by default) of ``columns``
    in that order; unknown -> nullable string."""
    full = T.StructType.fromDDL(SUMMARY_TABLE_DDL) if full is None else full
    by_name = {f.name: f for f in full.fields}
    return T.StructType([by_name.get(c, T.StructField(c, T.StringType(), True)) for c in columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Frame -> exactly ``schema``: each field try-cast from the column of the
    same name, NULL when the frame lacks it."""
    have = _lookup(df)
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        base = F.col(src) if src is not None else F.lit(None)
        cols.append(base.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)
