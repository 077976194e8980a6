"""Size checks that gate broadcasts and driver-side literals.

Every broadcast and every collect in the library goes through one of these,
so what reaches the driver or an executor's memory has a counted bound.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_at_most(df: DataFrame, limit: int) -> int | None:
    """Row count if it is <= ``limit``, else None. Reads at most limit+1 rows."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def take_at_most(df: DataFrame, limit: int) -> list | None:
    """Rows if there are <= ``limit`` of them, else None (never more than
    limit+1 rows travel to the driver)."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table under the session's shared
    checkpoint folder and read it back: the lineage is cut (later size
    checks and the join do not recompute it, a lost executor does not force
    a recomputation), it costs one job, and the planner sees the real file
    size."""
    import uuid

    from ..session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_on_exit(df.sparkSession, path)
    note_table(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_open_scopes: list[list[str]] = []


def note_table(path: str) -> None:
    """Have the open scopes know a written table."""
    for paths in _open_scopes:
        paths.append(path)


def delete_on_exit(spark, path: str) -> None:
    """Have the file system delete ``path`` when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def drop_tables(spark, paths: list[str]) -> None:
    """Delete written tables now."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    paths.clear()


@contextmanager
def table_scope():
    """Collects the paths of the tables that :func:`materialize` writes."""
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield paths
    finally:
        _open_scopes.remove(paths)


def broadcast_if_small(df: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """Broadcast hint only behind a counted bound; otherwise leave the join
    to the planner (sort-merge with AQE skew splitting)."""
    if count_at_most(df, limit) is not None:
        return F.broadcast(df), True
    return df, False
