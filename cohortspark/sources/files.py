"""File checks through the Hadoop file system, so any configured store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any path of a glob, is there."""
    fs, hadoop_path = _resolve(spark, path)
    return len(fs.globStatus(hadoop_path) or []) > 0


def listing(spark: SparkSession, path: str) -> list[str]:
    """Name, length and change time of every file under a path or glob, sorted."""
    fs, hadoop_path = _resolve(spark, path)
    found = []
    for status in fs.globStatus(hadoop_path) or []:
        below = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in below]
    return sorted(found)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted file names directly below a folder."""
    fs, hadoop_path = _resolve(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def size_of(spark: SparkSession, path: str) -> int:
    """Length of a file in bytes."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.getFileStatus(hadoop_path).getLen()
