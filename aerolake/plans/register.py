"""Query register: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Flight queries read the ``events`` table and turn it into snapshot documents
(``sources.events_adapter``); upsert queries read ``orders``.  Queries whose
operator is a sink write to a fresh location under the shared checkpoint
directory and return the table as read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.contracts import (
    GOLD_METRIC_COLUMNS,
    GOLD_METRICS,
    GOLD_POSITION_COLUMNS,
    GOLD_POSITION_SCHEMA,
    GOLD_POSITIONS,
    METRIC_KEYS,
    POSITION_KEYS,
    SILVER_COLUMNS,
)
from aerolake.functions.time import epoch_to_ntz, ntz_to_epoch
from aerolake.operators.gold import (
    busiest_countries,
    country_metrics,
    gold_positions,
    ground_state_counts,
    latest_positions,
    row_counts,
)
from aerolake.operators.quality import CheckedTable, tables_violations
from aerolake.operators.silver import (
    dedup_positions,
    rejected_positions,
    typed_positions,
    valid_positions,
)
from aerolake.operators.upsert import fold_latest, insert_ignore, merge_counts, upsert
from aerolake.plans.pipeline import (
    LakePaths,
    bronze_to_silver,
    process_bronze,
    read_rejects,
    read_runs_table,
    replay_bronze,
    run_medallion,
)
from aerolake.sinks.lake import BRONZE_DIRECTORIES, bronze_directories, land_bronze, land_texts, read_lake_table, write_partitioned
from aerolake.sinks.serving import newest_serving, read_serving, serving_counts, upsert_serving_runs
from aerolake.sources.bronze import bronze_partition, corrupt_documents, decode_documents, read_bronze
from aerolake.sources.events_adapter import snapshot_documents
from aerolake.storage import fresh_path
from aerolake.streaming.incremental import incremental_silver as start_incremental

# Averages are rounded to 6 digits in registered queries so that a different
# summation order (Spark vs the SQL oracle) cannot change the compared value.
ROUND = 6
# Bronze directories are written in this local zone by the replay queries.
LOCAL_ZONE = "America/Recife"
ORDER_KEYS = ["o_orderkey"]
# The published table of positions: codes made of ``events`` are wider than the feed's, the
# widest being "short" and a 64-bit event id.
EVENT_POSITIONS = replace(GOLD_POSITIONS, max_len=GOLD_POSITIONS.max_len | {"aircraft_code": 25})
# The run instant of the live-run query, and the part size that spreads a run over files.
LIVE_RUN = 1_716_084_000
SMALL_PARTS = 50

# Silver as read from landed files, whose paths differ from run to run of a query.
STREAM_COLUMNS = [c for c in SILVER_COLUMNS if c != "source_file_path"]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_documents(_table(spark, sf_dir, "events"))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_positions(decode_documents(documents(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_to_silver(documents(spark, sf_dir))


def serving_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving detail table after every hourly upsert: last run wins per key."""
    return fold_latest(
        silver(spark, sf_dir), POSITION_KEYS, ["ingested_at", "source_file_path"], GOLD_POSITION_COLUMNS
    )


def serving_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = country_metrics(silver(spark, sf_dir), keep_run=True, round_digits=ROUND)
    return fold_latest(runs, METRIC_KEYS, ["ingested_at"], GOLD_METRIC_COLUMNS)


def _orders_target_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The upsert scenario over the whole ``orders`` table: the target holds the
    orders whose key is not a multiple of 3, the batch delivers every key that is
    even or a multiple of 3 with a changed status and price (multiples of 3 are
    new, the other even keys are updates).  Every key is on one side at least, so
    the result has every row of ``orders``."""
    orders = _table(spark, sf_dir, "orders")
    target = orders.where(F.col("o_orderkey") % 3 != 0)
    batch = orders.where((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 == 0)).select(
        "o_orderkey",
        "o_custkey",
        F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return target, batch


def q_upsert_result(spark, d):
    target, batch = _orders_target_batch(spark, d)
    return upsert(target, batch, ORDER_KEYS)


def q_upsert_counts(spark, d):
    target, batch = _orders_target_batch(spark, d)
    return merge_counts(target, batch, ORDER_KEYS)


def q_insert_ignore_result(spark, d):
    orders = _table(spark, d, "orders")
    target = orders.where(F.col("o_orderkey") % 3 != 0)
    batch = orders.where((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 == 0))
    return insert_ignore(target, batch)


def q_insert_ignore_duplicates(spark, d):
    """Every batch row twice: it is inserted once."""
    orders = _table(spark, d, "orders")
    batch = orders.where((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 == 0))
    return insert_ignore(orders.where(F.col("o_orderkey") % 3 != 0), batch.unionByName(batch))


def q_metrics_two_runs(spark, d):
    """Every snapshot ingested again half an hour later: runs of one hour share a group."""
    docs = documents(spark, d)
    again = docs.withColumn("record_timestamp_unix", F.col("record_timestamp_unix") + 1800)
    return country_metrics(bronze_to_silver(docs.unionByName(again)), round_digits=ROUND)


def q_contract_violations(spark, d):
    """Three tables in one pass; states are decoded once and Silver is read as written."""
    t = _written(typed(spark, d), "typed")
    s = _written(dedup_positions(valid_positions(t)), "silver")
    run = ["ingested_at"]
    return tables_violations(
        [
            CheckedTable(t, GOLD_POSITIONS, run, "gold_flight_positions@typed"),
            CheckedTable(s, GOLD_POSITIONS, run),
            CheckedTable(country_metrics(s, keep_run=True, round_digits=ROUND), GOLD_METRICS, run),
        ]
    )


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _landed(spark, d, zone: str) -> str:
    root = fresh_path(spark, "bronze")
    land_bronze(documents(spark, d), root, zone=zone, tasks=_tasks(spark))
    return root


def _tasks(spark: SparkSession) -> int:
    """Tasks of a landing: the tables have many hours of few states."""
    return spark.sparkContext.defaultParallelism


def q_bronze_partition_scan(spark, d):
    docs = read_bronze(spark, _landed(spark, d, LOCAL_ZONE), multi_line=False, zone=LOCAL_ZONE)
    entries = F.size(F.try_variant_get(F.col("states"), "$", "array<variant>"))
    return docs.groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(entries).cast("bigint").alias("state_entries")
    )


def q_bronze_hour_scan(spark, d):
    """The states of the first run's hour, read with its partition predicate."""
    root = _landed(spark, d, LOCAL_ZONE)
    docs = documents(spark, d).agg(F.min("record_timestamp_unix")).first()[0]
    instant = datetime.fromtimestamp(docs, tz=timezone.utc).replace(tzinfo=None)
    hour = read_bronze(spark, root, zone=LOCAL_ZONE).where(bronze_partition(instant, LOCAL_ZONE))
    return decode_documents(hour).drop("state_ordinal", "source_file_path")


def _texts(spark, d) -> DataFrame:
    """One JSON text an event, with a key the decode does not know; every 97th is cut off."""
    su = F.unix_seconds("ts") if dict(_table(spark, d, "events").dtypes)["ts"] == "timestamp" else ntz_to_epoch("ts")
    events = _table(spark, d, "events").select("event_id", (su - F.pmod(su, F.lit(3600))).alias("hu"))
    whole = F.format_string('{"time": %d, "feed": "f%d", "states": [["c%d"]]}', "hu", "event_id", "event_id")
    text = F.when(F.col("event_id") % 97 == 0, F.substring(whole, 1, 20)).otherwise(whole)
    return events.select(text.alias("value"), (F.col("hu") + 7200).alias("record_timestamp_unix"))


def q_bronze_land_texts(spark, d):
    """Landed texts, read back as text."""
    root = fresh_path(spark, "bronze-texts")
    land_texts(_texts(spark, d), root, tasks=_tasks(spark))
    back = spark.read.text(root)
    return back.select("value", *[F.col(c).cast("int").alias(c) for c in ("year", "month", "day", "hour")])


def q_bronze_corrupt_documents(spark, d):
    """Documents for the quarantine, with the run they came in."""
    root = fresh_path(spark, "bronze-texts")
    land_texts(_texts(spark, d), root, tasks=_tasks(spark))
    bad = corrupt_documents(read_bronze(spark, root))
    return bad.select("record_timestamp_unix", F.col("_corrupt_record").alias("document"))


def q_bronze_multiline_decode(spark, d):
    """Snapshots as indented files, one document a file, decoded."""
    root = fresh_path(spark, "bronze-indented")
    text = F.to_json(F.struct("time", "states", "state_offset"), {"pretty": "true"})
    at = epoch_to_ntz("record_timestamp_unix")
    parts = [f(at) for f in (F.year, F.month, F.dayofmonth, F.hour, F.minute, F.second)]
    stamp = F.format_string("flight_snapshot_%04d-%02d-%02d_%02d-%02d-%02d", *parts)
    docs = documents(spark, d)
    write_partitioned(docs.select(text.alias("value"), stamp.alias("snapshot")), root, ["snapshot"], fmt="text", max_records_per_file=1, tasks=_tasks(spark))
    back = read_bronze(spark, root, multi_line=True)
    return decode_documents(back).drop("state_ordinal", "source_file_path")


def _land_indented(docs: DataFrame, root: str, zone: str) -> None:
    """Snapshots as indented files, one document a file, in the directories of ``land_bronze``."""
    text = F.to_json(F.struct("time", "states", "state_offset"), {"pretty": "true"}).alias("value")
    write_partitioned(docs.select(text, *bronze_directories(zone)), root, BRONZE_DIRECTORIES, fmt="text", max_records_per_file=1, tasks=_tasks(docs.sparkSession))


def _processed(spark, d) -> LakePaths:
    """A lake made by one pass over all snapshots, of which every other hour is an indented file."""
    root, docs = fresh_path(spark, "bronze"), documents(spark, d)
    indented = (F.col("record_timestamp_unix") / 3600).cast("bigint") % 2 == 0
    _land_indented(docs.where(indented), root, LOCAL_ZONE)
    land_bronze(docs.where(~indented), root, zone=LOCAL_ZONE, tasks=_tasks(spark))
    lake = replace(LakePaths.under(fresh_path(spark, "lake")), gold_positions=None, gold_metrics=None)
    process_bronze(spark, root, lake, zone=LOCAL_ZONE)
    return lake


def q_bronze_default_mixed_formats(spark, d):
    """Silver of indented files and JSON Lines in one Bronze, read with the defaults."""
    return read_lake_table(spark, _processed(spark, d).silver, STREAM_COLUMNS)


def q_lake_rejects(spark, d):
    """The rejected states as the pipeline wrote them beside Silver."""
    return read_rejects(spark, _processed(spark, d)).select(*STREAM_COLUMNS, "reject_reason")


def q_lake_run_table(spark, d):
    """What the pipeline noted of each run: states read, rejected and kept."""
    runs = read_runs_table(spark, _processed(spark, d).runs)
    return runs.select("run", "states", "rejected", "kept", "quarantined")


def q_stamped_run_emptied(spark, d):
    """All of Bronze, then the same runs again, every fifth of them without states: those hold nothing any more."""
    lake = replace(LakePaths.under(fresh_path(spark, "lake")), gold_metrics=None, rejects=None)
    process_bronze(spark, _landed(spark, d, LOCAL_ZONE), lake, zone=LOCAL_ZONE)
    emptied = (F.col("record_timestamp_unix") / 3600).cast("bigint") % 5 == 0
    docs = documents(spark, d).withColumn("states", F.when(~emptied, F.col("states")))
    again = fresh_path(spark, "bronze")
    land_bronze(docs, again, zone=LOCAL_ZONE, tasks=_tasks(spark))
    process_bronze(spark, again, lake, zone=LOCAL_ZONE)
    return read_lake_table(spark, lake.gold_positions, GOLD_POSITION_COLUMNS, GOLD_POSITION_SCHEMA)


def q_incremental_far_late_run(spark, d):
    """The first run of all lands last, beside the newest one."""
    docs = documents(spark, d)
    first, last = docs.agg(F.min("record_timestamp_unix"), F.max("record_timestamp_unix")).first()
    far = F.col("record_timestamp_unix").isin(first, last)
    root, out, ckpt = (fresh_path(spark, n) for n in ("bronze", "silver-stream", "stream-ckpt"))
    for landed in (docs.where(~far), docs.where(far)):
        land_bronze(landed, root, tasks=_tasks(spark))
        start_incremental(spark, root, out, ckpt).awaitTermination()
    return read_lake_table(spark, out, STREAM_COLUMNS)


def q_silver_partition_roundtrip(spark, d):
    path = fresh_path(spark, "silver")
    write_partitioned(silver(spark, d), path)
    return read_lake_table(spark, path, SILVER_COLUMNS)


def q_silver_append_rerun(spark, d):
    path = fresh_path(spark, "silver")
    s = silver(spark, d)
    write_partitioned(s, path, mode="append")
    write_partitioned(s, path, mode="append")
    return read_lake_table(spark, path, SILVER_COLUMNS)


def q_silver_replace_rerun(spark, d):
    path = fresh_path(spark, "silver")
    s = silver(spark, d)
    write_partitioned(s, path, mode="replace_partitions")
    write_partitioned(s, path, mode="replace_partitions")
    return read_lake_table(spark, path, SILVER_COLUMNS)


def q_gold_partition_roundtrip(spark, d):
    path = fresh_path(spark, "gold-metrics")
    write_partitioned(country_metrics(silver(spark, d), round_digits=ROUND), path)
    return read_lake_table(spark, path, GOLD_METRIC_COLUMNS)


def q_bronze_replay(spark, d):
    root = _landed(spark, d, LOCAL_ZONE)
    lake = LakePaths.under(fresh_path(spark, "lake"))
    _, metrics = replay_bronze(spark, root, lake, zone=LOCAL_ZONE, round_digits=ROUND)
    return metrics


def q_bronze_replay_silver(spark, d):
    root = _landed(spark, d, LOCAL_ZONE)
    lake = LakePaths.under(fresh_path(spark, "lake"))
    replay_bronze(spark, root, lake, zone=LOCAL_ZONE)
    return read_lake_table(spark, lake.silver, STREAM_COLUMNS)


def q_bronze_replay_after_correction(spark, d):
    """A replay of all of Bronze, then of a Bronze without every fifth hour's states: those runs go."""
    lake = LakePaths.under(fresh_path(spark, "lake"))
    replay_bronze(spark, _landed(spark, d, LOCAL_ZONE), lake, zone=LOCAL_ZONE)
    emptied = (F.col("record_timestamp_unix") / 3600).cast("bigint") % 5 == 0
    docs = documents(spark, d).withColumn("states", F.when(~emptied, F.col("states")))
    corrected = fresh_path(spark, "bronze")
    land_bronze(docs, corrected, zone=LOCAL_ZONE, tasks=_tasks(spark))
    positions, _ = replay_bronze(spark, corrected, lake, zone=LOCAL_ZONE)
    return positions


def q_live_run_rerun(spark, d):
    """All snapshots as one live run, run twice: the metrics of one run."""
    root = _landed(spark, d, LOCAL_ZONE)
    lake = LakePaths.under(fresh_path(spark, "lake"))
    run_medallion(spark, root, lake, record_epoch=LIVE_RUN, round_digits=ROUND)
    return run_medallion(spark, root, lake, record_epoch=LIVE_RUN, round_digits=ROUND)[1]


def q_incremental_split_run(spark, d):
    """Every run's files lie in two landings and the stream takes some files at a time."""
    docs = snapshot_documents(_table(spark, d, "events"), SMALL_PARTS)
    part = F.coalesce("state_offset", F.lit(0)) / SMALL_PARTS
    root, out = fresh_path(spark, "bronze"), fresh_path(spark, "silver-stream")
    land_bronze(docs.where(part % 2 == 0), root, tasks=_tasks(spark))
    land_bronze(docs.where(part % 2 == 1), root, tasks=_tasks(spark))
    start_incremental(spark, root, out, fresh_path(spark, "stream-ckpt"), max_files_per_trigger=600).awaitTermination()
    return read_lake_table(spark, out, STREAM_COLUMNS)


def q_incremental_late_run(spark, d):
    """The runs of the first half of a month land after those of the second."""
    docs = documents(spark, d)
    late = F.dayofmonth(epoch_to_ntz("record_timestamp_unix")) < 16
    root, out, ckpt = (fresh_path(spark, n) for n in ("bronze", "silver-stream", "stream-ckpt"))
    for landed in (docs.where(~late), docs.where(late)):
        land_bronze(landed, root, tasks=_tasks(spark))
        start_incremental(spark, root, out, ckpt).awaitTermination()
    return read_lake_table(spark, out, STREAM_COLUMNS)


def q_incremental_silver(spark, d):
    root = _landed(spark, d, "UTC")
    out = fresh_path(spark, "silver-stream")
    query = start_incremental(spark, root, out, fresh_path(spark, "stream-ckpt"))
    query.awaitTermination()
    return read_lake_table(spark, out, STREAM_COLUMNS)


def _publish_two_batches(spark, history, contract, order, path) -> DataFrame:
    """Publish the history as two upsert batches (runs before / from the 16th)."""
    day = F.dayofmonth("ingested_at")
    upsert_serving_runs(spark, path, history.where(day < 16), contract, order)
    upsert_serving_runs(spark, path, history.where(day >= 16), contract, order)
    return read_serving(spark, path, contract).select(*contract.columns)


def q_serving_upsert_positions(spark, d):
    return _publish_two_batches(
        spark, silver(spark, d), EVENT_POSITIONS, ["ingested_at", "source_file_path"],
        fresh_path(spark, "serving-positions"),
    )


def q_serving_upsert_metrics(spark, d):
    runs = country_metrics(silver(spark, d), keep_run=True, round_digits=ROUND)
    return _publish_two_batches(
        spark, runs, GOLD_METRICS, ["ingested_at"], fresh_path(spark, "serving-metrics")
    )


def q_serving_latest_positions(spark, d):
    """The newest positions of the published table, read from its newest partitions."""
    path = fresh_path(spark, "serving-positions")
    _publish_two_batches(spark, silver(spark, d), EVENT_POSITIONS, ["ingested_at", "source_file_path"], path)
    return latest_positions(newest_serving(spark, path, EVENT_POSITIONS, 20)).select(*EVENT_POSITIONS.columns)


def q_serving_busiest_countries(spark, d):
    """The latest snapshots' busiest countries, read from the published table's newest partitions."""
    path = fresh_path(spark, "serving-metrics")
    _publish_two_batches(spark, country_metrics(silver(spark, d), keep_run=True, round_digits=ROUND), GOLD_METRICS, ["ingested_at"], path)
    return busiest_countries(newest_serving(spark, path, GOLD_METRICS, 20)).select(*GOLD_METRICS.columns)


def q_serving_manifest_counts(spark, d):
    """Rows of both published tables, from their manifests."""
    root, s = fresh_path(spark, "serving"), silver(spark, d)
    _publish_two_batches(spark, s, EVENT_POSITIONS, ["ingested_at", "source_file_path"], f"{root}/gold_flight_positions")
    _publish_two_batches(spark, country_metrics(s, keep_run=True, round_digits=ROUND), GOLD_METRICS, ["ingested_at"], f"{root}/gold_country_metrics")
    return serving_counts(spark, {n: f"{root}/{n}" for n in ("gold_flight_positions", "gold_country_metrics")})


def queries() -> dict[str, Query]:
    return {
        "bronze_states_decode": lambda s, d: decode_documents(documents(s, d)).drop("state_ordinal"),
        "silver_typed_projection": lambda s, d: typed(s, d).select(*SILVER_COLUMNS),
        "silver_validity_filter": lambda s, d: valid_positions(typed(s, d)).select(*SILVER_COLUMNS),
        "silver_rejects": lambda s, d: rejected_positions(typed(s, d)).select(
            *SILVER_COLUMNS, "reject_reason"
        ),
        "silver_dedup_positions": lambda s, d: dedup_positions(valid_positions(typed(s, d))).select(
            "ingested_at", "aircraft_code", "position_timestamp", "last_contact_timestamp",
            "flight_callsign", "latitude", "longitude",
        ),
        "silver_flight_positions": silver,
        "gold_flight_positions": lambda s, d: gold_positions(silver(s, d)),
        "gold_country_metrics": lambda s, d: country_metrics(silver(s, d), round_digits=ROUND),
        "ground_state_counts": lambda s, d: ground_state_counts(silver(s, d)),
        "serving_fold_positions": serving_positions,
        "serving_fold_metrics": serving_metrics,
        "latest_positions_topk": lambda s, d: latest_positions(serving_positions(s, d)),
        "busiest_countries_topk": lambda s, d: busiest_countries(serving_metrics(s, d)),
        "serving_row_counts": lambda s, d: row_counts(
            {
                "gold_flight_positions": serving_positions(s, d),
                "gold_country_metrics": serving_metrics(s, d),
            }
        ),
        "contract_violations": q_contract_violations,
        "upsert_result": q_upsert_result,
        "upsert_counts": q_upsert_counts,
        "insert_ignore_result": q_insert_ignore_result,
        "insert_ignore_duplicates": q_insert_ignore_duplicates,
        "gold_country_metrics_two_runs": q_metrics_two_runs,
        "bronze_hour_scan": q_bronze_hour_scan,
        "bronze_land_texts": q_bronze_land_texts,
        "bronze_corrupt_documents": q_bronze_corrupt_documents,
        "bronze_multiline_decode": q_bronze_multiline_decode,
        "bronze_default_mixed_formats": q_bronze_default_mixed_formats,
        "lake_rejects": q_lake_rejects,
        "lake_run_table": q_lake_run_table,
        "stamped_run_emptied": q_stamped_run_emptied,
        "bronze_replay_silver": q_bronze_replay_silver,
        "bronze_replay_after_correction": q_bronze_replay_after_correction,
        "live_run_rerun": q_live_run_rerun,
        "incremental_split_run": q_incremental_split_run,
        "incremental_late_run": q_incremental_late_run,
        "incremental_far_late_run": q_incremental_far_late_run,
        "bronze_partition_scan": q_bronze_partition_scan,
        "silver_partition_roundtrip": q_silver_partition_roundtrip,
        "silver_append_rerun": q_silver_append_rerun,
        "silver_replace_rerun": q_silver_replace_rerun,
        "gold_partition_roundtrip": q_gold_partition_roundtrip,
        "bronze_replay": q_bronze_replay,
        "incremental_silver": q_incremental_silver,
        "serving_upsert_positions": q_serving_upsert_positions,
        "serving_upsert_metrics": q_serving_upsert_metrics,
        "serving_latest_positions": q_serving_latest_positions,
        "serving_busiest_countries": q_serving_busiest_countries,
        "serving_manifest_counts": q_serving_manifest_counts,
    }
