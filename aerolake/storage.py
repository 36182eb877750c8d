"""Shared scratch locations for written intermediates.

Written tables and stream checkpoints go under the cluster's shared
``spark.checkpoint.dir``.  Only when the session has none and runs in one process
(``local`` master, as in tests) is a private directory created and registered as the
checkpoint directory; on a cluster a missing setting raises.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The session's checkpoint directory, set to a fresh local one if unset.

    Also makes sure ``DataFrame.checkpoint()`` can be used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server owns the setting
        if root:
            return root.rstrip("/")
        raise ValueError("set spark.checkpoint.dir to a folder that the server and its executors share") from None
    root = root or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if root:
        if not current:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if current:
        # setCheckpointDir appends a per-application sub-directory; use its parent
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    local = tempfile.mkdtemp(prefix="aerolake-ckpt-")
    sc.setCheckpointDir(local)
    return local


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location ``<shared root>/aerolake/<name>-<uuid>``."""
    return f"{shared_root(spark)}/aerolake/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path object."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def uri_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and authority."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path; 0 if it does not exist."""
    system, target = _file_system(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    system, target = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    system, target = _file_system(spark, path)
    stream = system.create(target, False)
    try:
        stream.writeBytes(text)
    finally:
        stream.close()
