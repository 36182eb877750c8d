"""Session helpers: shared intermediate tables and worker imports."""

from __future__ import annotations

import os
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

from aerolake.storage import fresh_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def use_package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; in a
    local session started elsewhere the workers only need the path.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of plans that nobody refers to any more.

    The cleaner acts on the driver's garbage collections, which can be hours apart
    on an idle driver while the shuffle files of written steps fill the disks.
    """
    import gc

    gc.collect()
    with suppress(AttributeError):
        spark.sparkContext._jvm.System.gc()
