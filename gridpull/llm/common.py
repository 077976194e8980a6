"""Small helpers shared by the operators: stored tables, columns, text blocks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sizing
from ..session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


ROWS_A_PART = 50_000


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the session's shared checkpoint folder and
    read it back. Cuts the lineage, so a lost executor costs only its own
    running tasks. The folder goes when the application ends, or with the
    ``table_scope`` it was written in. ``rows``, where they are counted, keep
    small tables from many tiny files."""
    if rows is not None:
        df = df.coalesce(rows // ROWS_A_PART + 1)
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    sizing.delete_on_exit(spark, path)
    sizing.note_table(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint only if ``df`` has at most ``rows`` rows; larger
    sides are left to a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other code point kept. ``lower`` has a fast
    path for ASCII text and does the same there."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, UPPER, LOWER)).otherwise(F.lower(c))


def pick(df: DataFrame, name: str) -> Column:
    """The column of this very name, whatever it looks like."""
    return df["`" + name.replace("`", "``") + "`"]


def text_hash(text: Column) -> Column:
    """Tells rows that repeat an id apart by their text."""
    return F.xxhash64(text)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def in_blocks(batches: Iterator, limit: int) -> Iterator:
    """Regroup Arrow batches into tables of about ``limit`` bytes."""
    import pyarrow as pa

    held, size = [], 0
    for b in batches:
        if b.num_rows == 0:
            continue
        step = max(1, int(b.num_rows * limit / max(b.nbytes, 1)))
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def ship(spark: SparkSession, value):
    """Broadcast ``value`` with the code of its classes, so that workers need
    not import this package; read it with ``shipped``."""
    from pyspark import cloudpickle

    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(shared):
    import pickle

    return pickle.loads(shared.value)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
