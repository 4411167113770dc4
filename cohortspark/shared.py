"""Shared-storage helpers: where intermediate tables go and how lineage is cut.

Everything written here must be readable by every executor, so the folder comes from
``spark.checkpoint.dir``. Only a local master may fall back to a temporary folder, which goes when the process ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from the session."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = sc.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="cohortspark-")
        # The process that made the folder removes it; a configured folder belongs to its owner.
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from the written table.

    Worth it where one expensive result feeds several others: the per-sample table is read by
    the summaries, the comparisons, the distributions and the PCA. The files outlive lost
    executors, later readers scan only the columns they use, and their size is known to the
    optimizer.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
