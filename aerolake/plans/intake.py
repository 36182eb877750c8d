"""Intake of Bronze files: formats, one decode, and what became of every document and state.

``take_in`` decodes files once into a written table of typed states, each with the
reason it is rejected for, if any.  Everything that follows (Silver, rejects, counts
per reason and run) reads that table, so neither a reject sink nor the counts parse the
documents again, and no lake table is touched before all files are read.

Formats are told per file when none is given.  All files are read as JSON Lines first,
which Spark splits over tasks; this costs nothing more for a lake of lines.  Only if
lines failed, the files none of whose lines is a document are read once more, each as
one document over many lines.  What fails then is what goes to quarantine.  Files that
have bytes but do not yield a single document fail the intake.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.time import ntz_to_epoch
from aerolake.operators.silver import dedup_positions, reject_reason, silver_projection, typed_positions
from aerolake.sources.bronze import BRONZE_READ_SCHEMA, corrupt_documents, decode_documents, is_corrupt, read_bronze, stamped_run
from aerolake.storage import discard, fresh_path


class UnreadableBronze(ValueError):
    """Files that are not empty held no document that could be read."""


def bronze_files(
    spark: SparkSession, paths: Sequence[str], *, zone: str = "UTC", record_epoch: int | None = None, base_path: str | None = None
) -> DataFrame:
    """file, source_file_path (as rows name it), bytes, run and time of change of the files under ``paths``; no file is opened.

    Spark leaves out files of no bytes; a run that has no others counts as not read.
    """
    reader = spark.read.format("binaryFile")
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    listed = reader.load(list(paths))
    named = F.col("_metadata.file_path")
    run = stamped_run(named, zone) if record_epoch is None else F.lit(record_epoch).cast("bigint")
    modified = F.col("modificationTime").alias("modified")
    return listed.select(F.col("path").alias("file"), named.alias("source_file_path"), F.col("length").alias("bytes"), run.alias("run"), modified)


def _is_document() -> Column:
    # a line of an indented document can be an object too, but has neither key
    return F.col("time").isNotNull() | F.col("states").isNotNull()


def one_document_files(lines: DataFrame) -> DataFrame:
    """``source_file_path`` of the files, read as lines, that have no line which is a document."""
    seen = lines.groupBy("source_file_path").agg(F.count_if(_is_document()).alias("documents"), F.count_if(is_corrupt()).alias("corrupt"))
    return seen.where("documents = 0 AND corrupt > 0").select("source_file_path")


def judged_positions(docs: DataFrame, *, strict: bool = False) -> DataFrame:
    """Every state of the documents, typed, with the first rule it breaks (null: none)."""
    return typed_positions(decode_documents(docs, strict=strict)).withColumn("reject_reason", reject_reason())


@dataclass
class Intake:
    """Files read, and the typed states of their documents as written."""

    spark: SparkSession
    scratch: str
    counts: dict = field(default_factory=dict)
    runs: list[int] = field(default_factory=list)
    corrupt: DataFrame | None = None
    bytes_of: dict[int, tuple[int, int]] = field(default_factory=dict)

    @property
    def files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.scratch}/files")

    @property
    def states(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.scratch}/states")

    def silver(self) -> DataFrame:
        return silver_projection(dedup_positions(self.states.where("reject_reason IS NULL")))

    def rejects(self) -> DataFrame:
        return self.states.where("reject_reason IS NOT NULL")

    def outcome(self) -> DataFrame:
        """run, reject_reason (null: valid) and states of every run that has any; two columns are read."""
        return self.states.groupBy(ntz_to_epoch("ingested_at").alias("run"), "reject_reason").agg(F.count(F.lit(1)).alias("states"))

    def close(self) -> None:
        discard(self.spark, self.scratch)


def take_in(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    zone: str = "UTC",
    record_epoch: int | None = None,
    multi_line: bool | None = None,
    strict: bool = False,
    files: DataFrame | None = None,
    allow_unreadable: bool = False,
) -> Intake:
    """Read the files under ``paths``, or exactly ``files`` (of ``bronze_files``), into an ``Intake``.

    ``multi_line``: all files are one document (True) or lines (False); None tells per file.
    Raises ``UnreadableBronze`` if the files have bytes but not a document that can be read,
    unless ``allow_unreadable``.
    """
    intake = Intake(spark, fresh_path(spark, "intake"))
    try:
        listed = bronze_files(spark, paths, zone=zone, record_epoch=record_epoch) if files is None else files
        listed.write.parquet(f"{intake.scratch}/files")
        listed = intake.files
        for r in listed.groupBy("run").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).collect():
            intake.bytes_of[r.run] = (r.files, r.bytes)
        intake.runs = sorted(intake.bytes_of)
        if files is not None:
            paths = [r.file for r in listed.select("file").collect()]
        _read_states(intake, list(paths), listed, zone, record_epoch, multi_line, strict)
        found = intake.counts
        if found["quarantined"] and not found["documents"] and not allow_unreadable:
            raise UnreadableBronze(f"{found['files']} Bronze files of {found['bytes']} bytes hold no document that can be read")
    except BaseException:
        intake.close()
        raise
    return intake


def _no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{BRONZE_READ_SCHEMA}, source_file_path STRING, record_timestamp_unix BIGINT")


def _read_states(
    intake: Intake, paths: list[str], listed: DataFrame, zone: str, record_epoch: int | None, multi_line: bool | None, strict: bool
) -> None:
    spark, target = intake.spark, f"{intake.scratch}/states"

    def read(some: list[str], whole: bool) -> DataFrame:
        return read_bronze(spark, some, multi_line=whole, zone=zone, record_epoch=record_epoch)

    if not paths:
        judged_positions(_no_documents(spark), strict=strict).write.parquet(target)
        intake.counts = {"files": 0, "bytes": 0, "one_document_files": 0, "documents": 0, "quarantined": 0}
        return

    def decode(docs: DataFrame) -> tuple[int, int]:
        seen = Observation()
        docs = docs.observe(seen, F.count_if(_is_document()).alias("documents"), F.count_if(is_corrupt()).alias("corrupt"))
        judged_positions(docs, strict=strict).write.mode("append").parquet(target)
        return seen.get["documents"], seen.get["corrupt"]

    docs = read(paths, bool(multi_line))
    documents, corrupt = decode(docs)
    one_document = 0
    if corrupt and multi_line is None:
        one_document_files(docs).write.parquet(f"{intake.scratch}/whole")
        whole = spark.read.parquet(f"{intake.scratch}/whole")
        again = [r.file for r in listed.join(whole, "source_file_path", "left_semi").select("file").collect()]
        one_document = len(again)
        if again:
            entire = read(again, True)
            more, corrupt_files = decode(entire)
            rest = docs.join(whole, "source_file_path", "left_anti")
            documents += more
            corrupt = corrupt_files + rest.where(is_corrupt()).count()
            intake.corrupt = corrupt_documents(entire).unionByName(corrupt_documents(rest))
    if corrupt and intake.corrupt is None:
        intake.corrupt = corrupt_documents(docs)
    if not corrupt:
        intake.corrupt = None
    n_files, n_bytes = (sum(x) for x in zip(*intake.bytes_of.values())) if intake.bytes_of else (0, 0)
    intake.counts = {"files": n_files, "bytes": n_bytes, "one_document_files": one_document, "documents": documents, "quarantined": corrupt}
