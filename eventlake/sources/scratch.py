"""Places for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str, shared_root: str | None = None) -> str:
    """A new path in the shared folder the session names for checkpoints.

    Without such a folder, below ``shared_root``; only a local session that has
    neither gets a temporary directory. What lies there is removed when the application
    ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or shared_root
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="eventlake-")
    path = f"{root.rstrip('/')}/eventlake/{name}-{uuid.uuid4().hex}"
    where, store = file_store(spark, path)
    store.deleteOnExit(where)
    return path


def file_store(spark: SparkSession, path: str):
    """A path and its file system, as the JVM's objects."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())
