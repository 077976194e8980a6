"""A data-skipping index of a Parquet table: which files may answer sets.

For every file, ids are hashed to ``slots`` slots, and each slot that the file
holds keeps the bounds of its dates. The sets join this small table on their
ids' slots first; the fact read then gets the files that are left. So any
number of sets prunes files by id and date together, without a literal for
each id. A file that is new or was written anew since the index is always
read, so a stale index costs time and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..operators.joins import prepared_sets
from ..operators.sizing import broadcast_if_small

SLOTS = 4096
FILE = ["file", "size", "written"]


def _listing(spark: SparkSession, fact_path: str) -> DataFrame:
    """(file, size, written) of the table's files, from the file system's
    listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(fact_path)
    return files.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("written")
    )


def _slot(id_col, slots: int):
    return F.pmod(F.xxhash64(id_col), F.lit(slots)).cast("int")


def write_file_index(spark: SparkSession, fact_path: str, index_path: str, id_col: str, date_col: str, slots: int = SLOTS) -> str:
    """Write the index of the Parquet table at ``fact_path``: ``files`` (file,
    size, written, slots) and ``slots`` (file, slot, lo, hi, undated), at most
    ``slots`` rows a file."""
    index_path = index_path.rstrip("/")
    _listing(spark, fact_path).withColumn("slots", F.lit(slots)).write.parquet(f"{index_path}/files")
    fact = spark.read.parquet(fact_path).where(F.col(id_col).isNotNull())
    d = F.col(date_col).try_cast("timestamp_ntz")
    held = fact.groupBy(F.col("_metadata.file_path").alias("file"), _slot(F.col(id_col), slots).alias("slot"))
    held = held.agg(F.min(d).alias("lo"), F.max(d).alias("hi"), F.max(d.isNull()).alias("undated"))
    held.repartitionByRange("slot").sortWithinPartitions("slot", "file").write.parquet(f"{index_path}/slots")
    return index_path


def files_for_sets(spark: SparkSession, fact_path: str, index_path: str, params: DataFrame, cfg: ExtractConfig) -> list[str]:
    """The files that may hold a row of some set. The list is a part of the
    table's file listing."""
    index_path = index_path.rstrip("/")
    fact = spark.read.parquet(fact_path)
    cfg = cfg.with_(tie_break=()).resolved(fact.columns)
    known = spark.read.parquet(f"{index_path}/files")
    slots = (known.select("slots").first() or [SLOTS])[0]
    sets = prepared_sets(fact, params, cfg).select(_slot(F.col("_pid"), slots).alias("slot"), "_ps", "_pe").distinct()
    sets, _ = broadcast_if_small(sets, cfg.broadcast_max_sets)
    held = spark.read.parquet(f"{index_path}/slots")
    dated = (F.col("_ps").isNull() | (F.col("hi") >= F.col("_ps"))) & (F.col("_pe").isNull() | (F.col("lo") <= F.col("_pe")))
    undated = F.col("undated") & F.col("_ps").isNull() & F.col("_pe").isNull()
    asked = held.join(sets, "slot").where(dated | undated).select("file").distinct()
    now = _listing(spark, fact_path)
    unknown = now.join(known, FILE, "left_anti").select("file")
    wanted = now.select("file").join(asked, "file", "left_semi").unionByName(unknown).distinct()
    # the paths are URIs: %-escapes decoded, '+' is a plain character
    path = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
    return sorted(r[0] for r in wanted.select(path).collect())


def read_for_sets(spark: SparkSession, fact_path: str, index_path: str, params: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """The table at ``fact_path``, from the files that may answer ``params``."""
    whole = spark.read.parquet(fact_path)
    files = files_for_sets(spark, fact_path, index_path, params, cfg)
    if not files:
        return whole.where(F.lit(False))
    return spark.read.schema(whole.schema).option("basePath", fact_path).parquet(*files)
