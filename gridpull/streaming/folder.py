"""Sheets arriving in a folder, answered per micro-batch.

The sheet workflow is trigger-driven: a sheet is exported, then answered. The
folder is a file source that yields the paths of new sheets; each micro-batch
is a batch run over its paths. Results go to ``<out>/batch=<epoch>``, sheets
that could not be answered to ``<out>_errors/batch=<epoch>``; a replayed epoch
replaces the same folders, and progress lives in the query's checkpoint
location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import ExtractConfig
from ..plans.extract import run_batch
from ..sources.csv_sink import write_csv


def answer_sheet_stream(
    spark: SparkSession,
    folder: str,
    fact: DataFrame,
    cfg: ExtractConfig,
    out_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start a stream over ``folder``; every new sheet file is answered
    against ``fact``. ``max_files_per_trigger`` bounds a micro-batch and so
    the paths that the driver hands to its batch run."""
    paths = (
        spark.readStream.format("binaryFile")
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(folder)
        .select("path")
    )
    base = out_path.rstrip("/")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        new = [r["path"] for r in batch.collect()]
        if not new:
            return
        done = run_batch(spark, new, fact, cfg, out_path=f"{base}/batch={epoch_id}")
        write_csv(done.errors, f"{base}_errors/batch={epoch_id}")
        done.release()

    w = paths.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
