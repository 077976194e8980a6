"""Session helpers for tests, the bench and local runs.

Library functions never create sessions; they take the caller's. Here we
only fill in settings that are unset, so a cluster's own configuration
(checkpoint folder, shuffle partitions, AQE) always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "gridpull", extra: dict | None = None) -> SparkSession:
    """A local[N] session with sane small-machine defaults (tests / bench)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a single-JVM local session without one (tests, the bench)
    gets a scratch folder; any other session without one is refused, because
    a machine-local folder would scatter written tables over the nodes.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder (e.g. on HDFS or object storage)")
        d = tempfile.mkdtemp(prefix="gridpull-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
