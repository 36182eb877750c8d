"""Partitioned Parquet lake tables and Bronze landing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolake.contracts import LAKE_PARTITION_COLUMNS
from aerolake.functions.time import epoch_to_ntz, ntz_to_epoch
from aerolake.storage import discard

# A run's rows lie in a directory of their own, which a repeated run replaces.
RUN_COLUMN = "run"
RUN_PARTITION_COLUMNS = [*LAKE_PARTITION_COLUMNS, RUN_COLUMN]

WRITE_MODES = ("append", "replace_partitions", "overwrite")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = LAKE_PARTITION_COLUMNS,
    mode: str = "append",
    *,
    max_records_per_file: int = 5_000_000,
    fmt: str = "parquet",
    rebalance: bool = True,
    tasks: int | None = None,
) -> str:
    """Write ``df`` as Hive-partitioned files.

    ``append`` adds files (a rerun duplicates rows), ``replace_partitions``
    replaces only the partitions present in ``df`` (idempotent rerun /
    replay), ``overwrite`` replaces the whole table.

    Rows are rebalanced on the partition columns first (one shuffle): AQE
    packs small partitions into few files and splits a hot one (an hour
    holding a third of the data) into several tasks, so there are neither
    tasks x partitions tiny files nor one giant task.  When the rows all fall
    into one partition (a live hourly run) and already come from a shuffle
    that AQE sized, pass ``rebalance=False`` to save that extra shuffle; also when they
    are read from files that hold one partition each, as those of a lake table do.
    AQE packs a small input with many partitions into one task, which then makes
    all the files in turn; ``tasks`` deals the partitions over that many tasks
    instead, for inputs known to be small (see ``few_tasks``).
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, got {mode!r}")
    cols = list(partition_by)
    if cols and tasks:
        out = df.repartition(tasks, *cols)
    else:
        out = df.hint("rebalance", *cols) if cols and rebalance else df
    writer = out.write.option("maxRecordsPerFile", max_records_per_file)
    if cols:
        writer = writer.partitionBy(*cols)
    if mode == "append":
        writer = writer.mode("append")
    elif mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.format(fmt).save(path)
    return path


#: bytes up to which a write is dealt over all cores by partition, not sized by AQE
SMALL_BYTES = 1 << 30


def few_tasks(spark: SparkSession, size: int) -> int | None:
    """``tasks`` of a write of about this many bytes: a task a core if they are few."""
    return spark.sparkContext.defaultParallelism if size <= SMALL_BYTES else None


def write_runs(
    df: DataFrame,
    path: str,
    mode: str = "replace_partitions",
    columns: Sequence[str] | None = None,
    tasks: int | None = None,
    *,
    rebalance: bool = True,
) -> str:
    """Write rows (``columns`` of them) of any number of runs (by ``ingested_at``), each run to its own partition.

    ``replace_partitions`` replaces the runs that have rows in ``df``; ``overwrite``
    replaces the whole table.
    """
    rows = df.select(*(columns or df.columns), ntz_to_epoch("ingested_at").alias(RUN_COLUMN))
    return write_partitioned(rows, path, RUN_PARTITION_COLUMNS, mode, rebalance=rebalance, tasks=tasks)


def run_directory(path: str, record_epoch: int) -> str:
    at = datetime.fromtimestamp(record_epoch, tz=timezone.utc)
    return f"{path}/snapshot_date={at:%Y-%m-%d}/snapshot_hour={at.hour}/{RUN_COLUMN}={record_epoch}"


def write_run(df: DataFrame, path: str, record_epoch: int, *, max_records_per_file: int = 5_000_000) -> str:
    """Write the rows of one run, in place of what that run wrote before.

    The tasks are those of the shuffle the rows come from, sized by AQE.  A run
    without rows leaves an empty file, so nothing of an earlier attempt stays.
    """
    rows = df.drop(*LAKE_PARTITION_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "static")
    rows.option("maxRecordsPerFile", max_records_per_file).parquet(run_directory(path, record_epoch))
    return path


def write_processed_runs(
    df: DataFrame,
    path: str,
    processed: Sequence[int],
    filled: Sequence[int],
    columns: Sequence[str] | None = None,
    tasks: int | None = None,
    *,
    rebalance: bool = True,
) -> None:
    """Write the rows of the processed runs, and take away what those of them that have no rows held.

    ``filled``: the processed runs that have rows in ``df``.  Runs that were not processed stay.
    """
    write_runs(df, path, "replace_partitions", columns, tasks, rebalance=rebalance)
    for run in set(processed) - set(filled):
        discard(df.sparkSession, run_directory(path, run))


def read_runs(spark: SparkSession, path: str, runs: Sequence[int], schema: StructType) -> DataFrame:
    """The rows of these runs, each of which has a directory; no other directory is listed."""
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[run_directory(path, r) for r in runs])


def read_lake_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a partitioned lake table; partition columns come back as DATE / INT.

    With ``schema`` nothing is inferred, so a table without any file is an empty one.
    """
    df = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns is not None else df


def bronze_directories(zone: str) -> list[Column]:
    """Values of the Bronze directories: the run instant in local ``zone``, and its stamp."""
    ingested = epoch_to_ntz("record_timestamp_unix")
    local = ingested if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ingested)
    # field extraction is zone-free on TIMESTAMP_NTZ (date_format is not)
    y, mo, d, h = F.year(local), F.month(local), F.dayofmonth(local), F.hour(local)
    stamp = F.format_string(
        "flight_snapshot_%04d-%02d-%02d_%02d-%02d-%02d", y, mo, d, h, F.minute(local), F.second(local)
    )
    return [
        F.format_string("%04d", y).alias("year"),
        F.format_string("%02d", mo).alias("month"),
        F.format_string("%02d", d).alias("day"),
        F.format_string("%02d", h).alias("hour"),
        stamp.alias("snapshot"),
    ]


BRONZE_DIRECTORIES = ["year", "month", "day", "hour", "snapshot"]


def land_texts(
    texts: DataFrame, root: str, zone: str = "UTC", mode: str = "append", *, text_col: str = "value", tasks: int | None = None
) -> str:
    """Land document texts as they came, one a line, in the directories of ``land_bronze``.

    All keys of a document and documents that cannot be parsed are kept.  Only line
    breaks, which JSON allows between tokens alone, become spaces.  Null texts are not landed.
    """
    line = F.translate(F.col(text_col), "\r\n", "  ").alias("value")
    out = texts.where(F.col(text_col).isNotNull()).select(line, *bronze_directories(zone))
    return write_partitioned(out, root, BRONZE_DIRECTORIES, mode, fmt="text", tasks=tasks)


def land_bronze(docs: DataFrame, root: str, zone: str = "UTC", mode: str = "append", *, tasks: int | None = None) -> str:
    """Land snapshot documents as JSON Lines under
    ``year=YYYY/month=MM/day=DD/hour=HH/snapshot=flight_snapshot_<stamp>/``.

    Directory date/hour and the stamp are the run instant in local ``zone``
    (the stamp is what a replay reads the run instant back from).  One line
    per document keeps the files splittable; ``time`` is omitted when unknown.
    Documents at hand as text are landed unchanged by ``land_texts`` instead.
    ``tasks``: see ``write_partitioned``, for many small snapshots at once.
    """
    out = docs.select("time", "states", "state_offset", *bronze_directories(zone))
    return write_partitioned(out, root, BRONZE_DIRECTORIES, mode, fmt="json", tasks=tasks)
