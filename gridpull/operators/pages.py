"""Pages of an ordered result from one sorted copy.

``write_pages`` range-sorts a frame once, each row with its place in its part,
and keeps the parts' first places. ``read_page`` then reads only the one or
two files that hold a page, whatever its number. The order should be total;
rows that tie keep the places they were written with.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PAGE_SIZE


def write_pages(df: DataFrame, order: Sequence[Column], path: str, mode: str = "errorifexists") -> str:
    """Write ``df`` in order below ``path``: ``rows`` and the ``parts`` table
    (file, first, n) with the place of each file's first row, from 0."""
    path = path.rstrip("/")
    low_bits = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sorted_df = df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_mid"))
    sorted_df.select(*df.columns, "_part", low_bits.alias("_at")).write.mode(mode).parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    parts = rows.groupBy("_part", F.col("_metadata.file_path").alias("file")).agg(F.min("_at").alias("_low"), F.count("*").alias("n"))
    before = Window.orderBy("_part", "_low").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    first = F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first")
    parts.select("file", "_part", "_low", first, "n").write.mode(mode).parquet(f"{path}/parts")
    return path


def _schema(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/rows").schema


def page_files(spark: SparkSession, path: str, page_no: int, size: int = PAGE_SIZE) -> list:
    """Rows (file, _part, _low, first, n) of the files that hold a page; at
    most as many as the page has rows."""
    lo = page_no * size
    parts = spark.read.parquet(f"{path.rstrip('/')}/parts")
    return parts.where((F.col("first") < lo + size) & (F.col("first") + F.col("n") > lo)).orderBy("first").collect()


def read_page(spark: SparkSession, path: str, page_no: int, size: int = PAGE_SIZE) -> DataFrame:
    """Rows ``page_no * size`` to ``page_no * size + size - 1``, in order."""
    path = path.rstrip("/")
    schema = _schema(spark, path)
    columns = [f"`{f.name}`" for f in schema.fields if f.name not in ("_part", "_at")]
    found = page_files(spark, path, page_no, size)
    if not found:
        return spark.createDataFrame([], schema).select(*columns)
    rows = spark.read.schema(schema).parquet(*[unquote(r["file"]) for r in found])
    lo = page_no * size
    place = F.lit(None).cast("long")
    for r in found:
        place = F.when(F.col("_part") == r["_part"], F.col("_at") - r["_low"] + r["first"]).otherwise(place)
    rows = rows.withColumn("_place", place).where((F.col("_place") >= lo) & (F.col("_place") < lo + size))
    return rows.orderBy("_place").select(*columns)
