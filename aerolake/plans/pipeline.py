"""Medallion compositions: Bronze -> Silver -> Gold, batch run and replay."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.contracts import (
    GOLD_METRIC_COLUMNS,
    GOLD_METRIC_SCHEMA,
    GOLD_POSITION_COLUMNS,
    GOLD_POSITION_SCHEMA,
    REJECT_SCHEMA,
    SERVING_CONTRACTS,
    SILVER_COLUMNS,
    SILVER_SCHEMA,
)
from aerolake.operators.gold import country_metrics, gold_positions
from aerolake.operators.silver import raw_to_silver
from aerolake.plans.intake import Intake, take_in
from aerolake.sinks.lake import (
    RUN_COLUMN,
    few_tasks,
    read_lake_table,
    read_runs,
    write_partitioned,
    write_processed_runs,
    write_run,
    write_runs,
)
from aerolake.sinks.serving import upsert_serving_runs
from aerolake.sources.bronze import decode_documents
from aerolake.storage import discard, size_of


def bronze_to_silver(docs: DataFrame, *, strict: bool = False) -> DataFrame:
    """Document frame -> Silver (22 columns)."""
    return raw_to_silver(decode_documents(docs, strict=strict))


def silver_to_gold(silver: DataFrame, *, round_digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver -> (detail positions, per-country metrics)."""
    return gold_positions(silver), country_metrics(silver, round_digits=round_digits)


@dataclass(frozen=True)
class LakePaths:
    silver: str
    gold_positions: str | None
    gold_metrics: str | None
    quarantine: str | None
    rejects: str | None = None
    runs: str | None = None

    @classmethod
    def under(cls, root: str) -> "LakePaths":
        root = root.rstrip("/")
        return cls(
            silver=f"{root}/clean/positions",
            gold_positions=f"{root}/reports/positions",
            gold_metrics=f"{root}/reports/countries",
            quarantine=f"{root}/quarantine/documents",
            rejects=f"{root}/quarantine/states",
            runs=f"{root}/runs",
        )


def written_silver(spark: SparkSession, lake: LakePaths, record_epoch: int | None = None) -> DataFrame:
    """Silver as written: one live run's rows (partition-pruned and pushed
    down to its ingest instant), or the whole table when ``record_epoch`` is None."""
    silver = read_lake_table(spark, lake.silver, SILVER_COLUMNS, SILVER_SCHEMA)
    if record_epoch is None:
        return silver
    run = datetime.fromtimestamp(record_epoch, tz=timezone.utc).replace(tzinfo=None)
    return silver.where(
        (F.col("snapshot_date") == F.lit(run.date()))
        & (F.col("snapshot_hour") == F.lit(run.hour))
        & (F.col("ingested_at") == F.expr(f"TIMESTAMP_NTZ'{run:%Y-%m-%d %H:%M:%S}'"))
    )


def publish_serving(
    spark: SparkSession,
    lake: LakePaths,
    serving_root: str,
    *,
    record_epoch: int | None = None,
    round_digits: int | None = None,
) -> dict[str, dict[str, int]]:
    """Upsert the Gold of the processed runs into the Parquet serving tables.

    A live run publishes its own rows; a replay publishes every run, folded so
    that the last run wins per key, as hourly publishes one after another would.
    """
    silver = written_silver(spark, lake, record_epoch)
    return publish_runs(spark, silver, serving_root, round_digits=round_digits)


def publish_runs(
    spark: SparkSession, silver: DataFrame, serving_root: str, *, round_digits: int | None = None
) -> dict[str, dict[str, int]]:
    """Upsert the Gold of these Silver rows, the last run first, into the serving tables."""
    metrics = country_metrics(silver, keep_run=True, round_digits=round_digits)
    root = serving_root.rstrip("/")
    return {
        name: upsert_serving_runs(spark, f"{root}/{name}", df, SERVING_CONTRACTS[name], order)
        for name, df, order in [
            # documents of one run may share keys: the file decides
            ("gold_flight_positions", silver, ["ingested_at", "source_file_path"]),
            ("gold_country_metrics", metrics, ["ingested_at"]),
        ]
    }


def write_gold(
    silver: DataFrame,
    lake: LakePaths,
    *,
    processed: Sequence[int] | None = None,
    filled: Sequence[int] = (),
    round_digits: int | None = None,
    tasks: int | None = None,
) -> None:
    """Write the Gold of these Silver rows: of the processed runs, or (None) the whole tables anew.

    ``silver`` is read from the lake, where a file holds rows of one run: the positions
    are written as they are read, without a shuffle.
    """
    metrics = country_metrics(silver, keep_run=True, round_digits=round_digits)
    for df, path, columns, how in (
        (gold_positions(silver), lake.gold_positions, None, {"rebalance": False}),
        (metrics, lake.gold_metrics, GOLD_METRIC_COLUMNS, {"tasks": tasks}),
    ):
        if path and processed is None:
            write_runs(df, path, "overwrite", columns, **how)
        elif path:
            write_processed_runs(df, path, processed, filled, columns, **how)


def write_quarantine(intake: Intake, path: str, *, rebuild: bool = False) -> dict[int, int]:
    """Write the documents that could not be parsed, by run, in place of what the runs read had there.

    Returns the number of each run that has any.
    """
    spark, counts = intake.spark, {}
    if rebuild:
        discard(spark, path)
    if intake.corrupt is not None:
        bad = intake.corrupt.withColumnsRenamed({"_corrupt_record": "document", "record_timestamp_unix": RUN_COLUMN})
        write_partitioned(bad, path, [RUN_COLUMN], "replace_partitions")
        written = spark.read.schema(f"source_file_path string, document string, {RUN_COLUMN} bigint").parquet(path)
        counts = {r[RUN_COLUMN]: r["count"] for r in written.groupBy(RUN_COLUMN).count().collect()}
    for run in set(intake.runs) - set(counts):
        discard(spark, f"{path}/{RUN_COLUMN}={run}")
    return {run: n for run, n in counts.items() if run in intake.bytes_of}


def write_intake(
    intake: Intake,
    lake: LakePaths,
    *,
    record_epoch: int | None = None,
    rebuild: bool = False,
    round_digits: int | None = None,
) -> dict:
    """Silver, rejects, Gold, quarantine and the run table of what was taken in; returns the counts.

    The runs *read* are replaced in every table, also by nothing; ``rebuild`` makes the
    tables anew.  Runs that were not read are neither read nor written.
    """
    spark, runs = intake.spark, intake.runs
    outcome = intake.outcome().collect()  # a row a run and reason
    filled = sorted({r.run for r in outcome if r.reject_reason is None})
    rejected = sorted({r.run for r in outcome if r.reject_reason is not None})
    silver = intake.silver()
    tasks = few_tasks(spark, size_of(spark, f"{intake.scratch}/states"))
    if record_epoch is not None:
        write_run(silver, lake.silver, record_epoch)
        written = read_runs(spark, lake.silver, [record_epoch], SILVER_SCHEMA)
    elif rebuild:
        write_runs(silver, lake.silver, "overwrite", tasks=tasks)
        written = read_lake_table(spark, lake.silver, schema=SILVER_SCHEMA)
    else:
        write_processed_runs(silver, lake.silver, runs, filled, tasks=tasks)
        written = read_runs(spark, lake.silver, filled, SILVER_SCHEMA)
    if lake.rejects:
        if rebuild:
            write_runs(intake.rejects(), lake.rejects, "overwrite", tasks=tasks)
        else:
            write_processed_runs(intake.rejects(), lake.rejects, runs, rejected, tasks=tasks)
    kept = {}
    if filled:
        kept = {r[RUN_COLUMN]: r["count"] for r in written.groupBy(RUN_COLUMN).count().collect()}
    if record_epoch is not None and lake.gold_positions and lake.gold_metrics:
        positions, metrics = silver_to_gold(written.select(*SILVER_COLUMNS), round_digits=round_digits)
        write_run(positions, lake.gold_positions, record_epoch)
        write_run(metrics, lake.gold_metrics, record_epoch)
    else:
        write_gold(written.select(*SILVER_COLUMNS), lake, processed=None if rebuild else runs, filled=filled, round_digits=round_digits, tasks=tasks)
    quarantined = write_quarantine(intake, lake.quarantine, rebuild=rebuild) if lake.quarantine else {}
    if lake.runs:
        _note_runs(intake, lake.runs, outcome, kept, quarantined, rebuild)
    reasons: dict[str, int] = {}
    for r in outcome:
        if r.reject_reason is not None:
            reasons[r.reject_reason] = reasons.get(r.reject_reason, 0) + r.states
    return intake.counts | {
        "runs": len(runs),
        "states": sum(r.states for r in outcome),
        "kept": sum(kept.values()),
        "rejected": reasons,
    }


RUNS_TABLE = "run bigint, files bigint, bytes bigint, quarantined bigint, states bigint, rejected bigint, kept bigint, processed timestamp"


def _note_runs(intake: Intake, path: str, outcome: list, kept: dict[int, int], quarantined: dict[int, int], rebuild: bool) -> None:
    """Add one row a run read, written last: what was read, and what became of it."""
    states: dict[int, int] = {}
    rejected: dict[int, int] = {}
    for r in outcome:
        states[r.run] = states.get(r.run, 0) + r.states
        rejected[r.run] = rejected.get(r.run, 0) + (r.states if r.reject_reason is not None else 0)
    at = datetime.now(timezone.utc)
    rows = [
        (run, files, size, quarantined.get(run, 0), states.get(run, 0), rejected.get(run, 0), kept.get(run, 0), at)
        for run, (files, size) in intake.bytes_of.items()
    ]
    table = intake.spark.createDataFrame(rows, RUNS_TABLE).coalesce(1)
    table.write.mode("overwrite" if rebuild else "append").parquet(path)


def read_runs_table(spark: SparkSession, path: str) -> DataFrame:
    """run, files, bytes, quarantined documents, states, rejected and kept states, as last processed, of every run."""
    noted = spark.read.schema(RUNS_TABLE).parquet(path)
    columns = [f.name for f in noted.schema.fields if f.name != "run"]
    last = noted.groupBy("run").agg(F.max_by(F.struct(*columns), "processed").alias("last"))
    return last.select("run", "last.*")


def read_rejects(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """The rejected states of every run processed, with the first rule each broke."""
    return read_lake_table(spark, lake.rejects, [*SILVER_COLUMNS, "state_ordinal", "reject_reason"], REJECT_SCHEMA)


def process_bronze(
    spark: SparkSession,
    bronze_path: str,
    lake: LakePaths,
    *,
    record_epoch: int | None = None,
    zone: str = "UTC",
    multi_line: bool | None = None,
    strict: bool = False,
    rebuild: bool = False,
    round_digits: int | None = None,
) -> dict:
    """Bronze files -> Silver, rejects, both Gold tables, quarantine and run table; returns the counts.

    The run is the unit of work.  With ``record_epoch`` all files belong to that
    live run.  Without it the runs are those of the path stamps; each replaces what
    it wrote before, in every table and also by nothing, and other runs are left
    alone.  ``rebuild`` makes the tables anew, so that runs which Bronze no longer has go.

    Documents are decoded once (see ``plans.intake``) before any table is touched.  Raises
    ``UnreadableBronze`` if there are files and none holds a document that can be read.
    """
    intake = take_in(spark, [bronze_path], zone=zone, record_epoch=record_epoch, multi_line=multi_line, strict=strict)
    try:
        return write_intake(intake, lake, record_epoch=record_epoch, rebuild=rebuild, round_digits=round_digits)
    finally:
        intake.close()


def run_medallion(spark: SparkSession, bronze_path: str, lake: LakePaths, **options) -> tuple[DataFrame, DataFrame]:
    """``process_bronze`` with the same options; returns the Gold tables as read back from the lake."""
    process_bronze(spark, bronze_path, lake, **options)
    return read_gold(spark, lake)


def read_gold(spark: SparkSession, lake: LakePaths) -> tuple[DataFrame, DataFrame]:
    return (
        read_lake_table(spark, lake.gold_positions, GOLD_POSITION_COLUMNS, GOLD_POSITION_SCHEMA),
        read_lake_table(spark, lake.gold_metrics, GOLD_METRIC_COLUMNS, GOLD_METRIC_SCHEMA),
    )


def replay_bronze(
    spark: SparkSession,
    bronze_root: str,
    lake: LakePaths,
    *,
    zone: str = "UTC",
    multi_line: bool | None = None,
    round_digits: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rebuild Silver and Gold from all of Bronze, idempotently.

    The run instant of every document comes from its path stamp (in local
    ``zone``), so history lands in its original date/hour partitions.  The lake
    tables then hold what this Bronze yields and nothing else: give it the whole
    root.  A rebuild that dies leaves incomplete tables; repeat it.
    """
    return run_medallion(
        spark,
        bronze_root,
        lake,
        record_epoch=None,
        zone=zone,
        multi_line=multi_line,
        rebuild=True,
        round_digits=round_digits,
    )
