"""Incremental runs: process only Bronze files not processed before.

A file stream over the Bronze root with a checkpoint replaces the hourly
scheduler: ``availableNow`` processes everything new and stops, so a rerun
with nothing new adds nothing.

The run is the unit of work.  A micro-batch only tells which runs have new
files (their names; they are not opened for it); those runs are recomputed whole, from
all their files in Bronze, by the batch operators, and replace their own
partitions in Silver and Gold, also by nothing.  So a run whose files are spread
over micro-batches, a run that lands late and a micro-batch that is executed again
all end in what one batch run gives, with no watermark that could drop anything and
no state to keep.

A run is read with all the files it has by then, also those that a later micro-batch
will name.  They are noted in the checkpoint (``read-ahead``); a later micro-batch passes
over the runs of which it names noted files alone, since these already hold them.

Cost: a run is read again only by a micro-batch that names files which landed, or changed,
since it was last read.  Only the Bronze hours of the touched runs are listed, and of
these only the touched runs' files are read; of Silver only their directories.  A run of
a year ago beside one of today reads two hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.contracts import SILVER_COLUMNS, SILVER_SCHEMA
from aerolake.plans.intake import bronze_files, take_in
from aerolake.plans.pipeline import LakePaths, publish_runs, write_intake
from aerolake.sinks.lake import read_runs, run_directory
from aerolake.sources.bronze import BRONZE_READ_SCHEMA, stamped_run
from aerolake.storage import discard, exists, fresh_path, uri_path

_HOUR_DIRECTORY = r"(/year=\d+/month=\d+/day=\d+/hour=\d+)/"
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# A file as it was read: one that changes afterwards is another.
FILE_KEYS = ["path", "modified", "length"]
AHEAD_SCHEMA = "path STRING, modified TIMESTAMP, length BIGINT"


def bronze_stream(
    spark: SparkSession,
    bronze_root: str,
    *,
    zone: str = "UTC",
    multi_line: bool = False,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming document frame over a Bronze root (new files only).

    With ``archive_dir`` processed files are moved there after each batch
    (``cleanSource=archive``), so the per-trigger listing of the source stays
    proportional to new data instead of the whole history.
    """
    reader = (
        spark.readStream.schema(BRONZE_READ_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    raw = reader.json(bronze_root)
    fp = F.col("_metadata.file_path")
    return raw.select("*", fp.alias("source_file_path"), stamped_run(fp, zone).alias("record_timestamp_unix"))


def bronze_file_stream(
    spark: SparkSession, bronze_root: str, *, max_files_per_trigger: int | None = None, archive_dir: str | None = None
) -> DataFrame:
    """Streaming frame of the new files of a Bronze root; contents are read only if selected.

    With ``archive_dir`` processed files are moved there after each batch.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(bronze_root)


def batch_files(batch: DataFrame, path: str, zone: str = "UTC") -> DataFrame:
    """Write the files of a micro-batch with their runs and Bronze hours (empty if the layout has none)."""
    hour = F.regexp_extract("path", _HOUR_DIRECTORY, 1)
    run, modified = stamped_run(F.col("path"), zone), F.col("modificationTime")
    batch.select("path", modified.alias("modified"), "length", run.alias("run"), hour.alias("hour")).write.parquet(path)
    return batch.sparkSession.read.parquet(path)


def read_ahead(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """Files that micro-batches before this one read and that none of them named."""
    path = _ahead_path(checkpoint, batch_id - 1)
    return spark.read.schema(AHEAD_SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], AHEAD_SCHEMA)


def note_read_ahead(ahead: DataFrame, named: DataFrame, read: DataFrame | None, checkpoint: str, batch_id: int) -> None:
    """Note the files read by now (state as read) and not named yet, for the next micro-batch.

    Written when all tables are, so a micro-batch that dies is repeated from the same note.
    """
    files = ahead if read is None else ahead.unionByName(read.select(F.col("file").alias("path"), "modified", F.col("bytes").alias("length")))
    left = files.distinct().join(named, FILE_KEYS, "left_anti")
    left.write.mode("overwrite").parquet(_ahead_path(checkpoint, batch_id))
    discard(ahead.sparkSession, _ahead_path(checkpoint, batch_id - 2))


def _ahead_path(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint.rstrip('/')}/read-ahead/{batch_id}"


def files_of_runs(
    spark: SparkSession, touched: DataFrame, bronze_root: str, *, zone: str = "UTC", archive_dir: str | None = None
) -> DataFrame:
    """All files of the touched runs (see ``bronze_files``), also those of earlier micro-batches.

    Only the hours of the touched runs are listed.  The root is listed before the
    archive: a file that moves in between fails the read, and the micro-batch is
    repeated, but it is never missed.
    """
    hours = sorted(r.hour for r in touched.select("hour").distinct().collect())
    root = bronze_root.rstrip("/")
    roots = [root]
    if archive_dir is not None:
        roots.append(f"{archive_dir.rstrip('/')}{uri_path(spark, root)}")
    found = None
    for top in roots:
        places = [f"{top}{h}" for h in hours] if "" not in hours else [top]
        places = [p for p in places if exists(spark, p)]
        if places:
            files = bronze_files(spark, places, zone=zone, base_path=top)
            found = files if found is None else found.unionByName(files)
    if found is None:
        raise FileNotFoundError(f"no files of the touched runs under {roots}")
    return found.join(touched.select("run").distinct(), "run", "left_semi").select("file", "source_file_path", "bytes", "run", "modified")


def incremental_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    checkpoint: str,
    *,
    zone: str = "UTC",
    multi_line: bool | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    gold_positions_path: str | None = None,
    gold_metrics_path: str | None = None,
    serving_root: str | None = None,
    quarantine_path: str | None = None,
    rejects_path: str | None = None,
    runs_path: str | None = None,
    round_digits: int | None = None,
) -> StreamingQuery:
    """Start the Bronze -> Silver (-> Gold -> serving) stream; returns the running query.

    With Gold paths and/or ``serving_root`` each micro-batch continues like the
    hourly batch job: Gold of its runs from the Silver just written, then the upsert
    (a run that lands late is published late, over what newer runs published for
    the same keys, as separate hourly jobs would).  Documents that cannot be parsed go
    to ``quarantine_path`` (by run); without one they fail the micro-batch.  Rejected
    states and the run table are written where paths for them are given.
    """
    files = bronze_file_stream(spark, bronze_root, max_files_per_trigger=max_files_per_trigger, archive_dir=archive_dir)
    lake = LakePaths(silver_path, gold_positions_path, gold_metrics_path, quarantine_path, rejects_path, runs_path)

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        scratch = fresh_path(session, "batch-files")
        intake = None
        try:
            named = batch_files(batch, f"{scratch}/files", zone)
            ahead = read_ahead(session, checkpoint, batch_id)
            touched = named.join(ahead, FILE_KEYS, "left_anti").select("run", "hour").distinct()
            if not touched.isEmpty():
                whole = files_of_runs(session, touched, bronze_root, zone=zone, archive_dir=archive_dir)
                intake = take_in(session, [], zone=zone, multi_line=multi_line, files=whole, allow_unreadable=quarantine_path is not None)
                if intake.corrupt is not None and quarantine_path is None:
                    raise ValueError("Bronze documents that cannot be parsed, and no quarantine_path")
                write_intake(intake, lake, round_digits=round_digits)
            if serving_root:
                # also of the runs passed over: they are published as late as their last file is named
                runs = sorted(r.run for r in named.select("run").distinct().collect())
                filled = [run for run in runs if exists(session, run_directory(silver_path, run))]
                written = read_runs(session, silver_path, filled, SILVER_SCHEMA).select(*SILVER_COLUMNS)
                publish_runs(session, written, serving_root, round_digits=round_digits)
            note_read_ahead(ahead, named, intake.files if intake is not None else None, checkpoint, batch_id)
        finally:
            if intake is not None:
                intake.close()
            discard(session, scratch)

    writer = files.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time is not None:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

