"""Keyed upsert into a versioned Parquet serving table (no MERGE needed).

A table lies under one path:

    data/version=<id>/key_date=/key_slot=/key_part=/   rows, written by one publish and never changed
    manifests/<id>/                                    one row a live partition, written by one publish
    log/_<number>                                      one small file a publish, which names its manifest

Ids of versions and manifests, and log entries, begin with an underscore, so Spark, which lists
no such names, sees the rows alone under the path: those of all versions, replaced ones too.
Use ``read_serving`` for the table.

Every key lives in one partition: the day and the slot of the day (an hour by
default) of its time key, and a hash of the key if the table has several parts.
A publish collects the partitions its batch falls in (hours, not rows), reads these
directories and no others, merges, and writes them anew under its own version.  The
manifest of the new table takes all other partitions over from the last one.

The log is the only pointer.  Its next file appears when data and manifest are whole,
so a reader at any moment, also after a publish that died anywhere, sees the table
before or after a publish.  What a dead publish left is removed by the next one.
Replaced partitions stay readable for ``KEEP`` versions.  One publish at a time: a
second one that takes the same number fails.

Manifests also carry each partition's rows and the bounds of the table's report
column, so counts need no scan and the newest rows are read from the newest
partitions only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.contracts import TableContract
from aerolake.operators.quality import enforce_contract
from aerolake.operators.upsert import fold_latest, merge_counts, upsert
from aerolake.sinks.lake import few_tasks, write_partitioned
from aerolake.storage import create_new, discard, fresh_path, names, read_small, size_of

KEY_DATE, KEY_SLOT, KEY_PART = PARTITION = ["key_date", "key_slot", "key_part"]
VERSION = "version"
MANIFEST = "version string, key_date date, key_slot int, key_part int, rows long, oldest timestamp_ntz, newest timestamp_ntz"
#: versions of a table that stay readable
KEEP = 3


@dataclass(frozen=True)
class Snapshot:
    """A table as of one publish."""

    path: str
    number: int
    manifest_id: str
    slots: int
    parts: int

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{self.manifest_id}")


def time_key(contract: TableContract) -> str:
    return next(k for k in contract.keys if k.endswith("timestamp"))


def report_column(contract: TableContract) -> str:
    """The column that reports order the table by, newest first."""
    return "ingested_at" if "ingested_at" in contract.columns else time_key(contract)


def partition_columns(contract: TableContract, slots: int, parts: int) -> list[Column]:
    """Day, slot of the day and hash part of a row's key."""
    at = F.col(time_key(contract))
    seconds = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at).cast("int")
    part = F.pmod(F.xxhash64(*contract.keys), F.lit(parts)) if parts > 1 else F.lit(0)
    return [F.to_date(at).alias(KEY_DATE), F.floor(seconds * slots / 86400).cast("int").alias(KEY_SLOT), part.cast("int").alias(KEY_PART)]


def snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """The table's committed versions that are still kept, oldest first."""
    found = []
    for number, name in _entries(spark, path):
        try:
            entry = json.loads(read_small(spark, f"{path}/log/{name}"))
        except ValueError:  # being written, or left by a writer that died: not committed
            continue
        found.append(Snapshot(path, number, entry["manifest"], entry["slots"], entry["parts"]))
    return found


def _entries(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and names of the log's files, in order; earlier ones have no underscore."""
    found = [(n.removeprefix("_"), n) for n in names(spark, f"{path}/log")]
    return sorted((int(number), name) for number, name in found if number.isdigit())


def current(spark: SparkSession, path: str) -> Snapshot | None:
    return next(reversed(snapshots(spark, path.rstrip("/"))), None)


def _directories(snapshot_path: str, partitions: Sequence) -> list[str]:
    return [f"{snapshot_path}/data/{VERSION}={p.version}/{KEY_DATE}={p.key_date}/{KEY_SLOT}={p.key_slot}/{KEY_PART}={p.key_part}" for p in partitions]


def _read(spark: SparkSession, snapshot: Snapshot, partitions: Sequence, contract: TableContract) -> DataFrame:
    """The rows of these partitions; no other directory is listed."""
    rows = spark.read.option("basePath", f"{snapshot.path}/data").parquet(*_directories(snapshot.path, partitions))
    return rows.select(*contract.columns, *PARTITION)


def _unversioned(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written before versions, one directory a day; None if there is none."""
    if not any(n.startswith(f"{KEY_DATE}=") for n in names(spark, path)):
        return None
    return spark.read.parquet(path)


def read_serving(spark: SparkSession, path: str, contract: TableContract) -> DataFrame | None:
    """The serving table as last published, or None if it was not created yet; a table that lacks a
    contract column raises."""
    snapshot = current(spark, path)
    if snapshot is None:
        old = _unversioned(spark, path.rstrip("/"))
        return None if old is None else old.select(*contract.columns, KEY_DATE)
    return _read(spark, snapshot, snapshot.manifest(spark).collect(), contract).drop(KEY_SLOT, KEY_PART)


def newest_serving(spark: SparkSession, path: str, contract: TableContract, n: int) -> DataFrame | None:
    """The partitions that hold the ``n`` newest rows by the report column, ties included.

    Decided from the manifest: partitions whose oldest value is at least t hold n rows,
    so no row below t is among the newest, and partitions whose newest is below t are not read.
    """
    snapshot = current(spark, path)
    if snapshot is None:
        return read_serving(spark, path, contract)
    partitions = sorted(snapshot.manifest(spark).collect(), key=lambda p: p.oldest, reverse=True)
    safe, bound = 0, None
    for p in partitions:
        safe += p.rows
        if safe >= n:
            bound = p.oldest
            break
    needed = [p for p in partitions if bound is None or p.newest >= bound]
    return _read(spark, snapshot, needed, contract).drop(KEY_SLOT, KEY_PART)


def serving_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One ``(table_name, row_count)`` row a table, from the manifests alone."""
    out = None
    for name, path in paths.items():
        snapshot = current(spark, path)
        rows = spark.createDataFrame([], MANIFEST) if snapshot is None else snapshot.manifest(spark)
        counted = rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = counted if out is None else out.unionByName(counted)
    return out


def upsert_serving(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    contract: TableContract,
    *,
    newer_than: str | None = None,
    keys_unique: bool = False,
    slots: int = 24,
    parts: int = 1,
) -> dict[str, int]:
    """Upsert ``batch`` into the serving table at ``path``; returns the counts.

    New keys are inserted, existing keys take every non-key column from the
    batch (only if at least as new by ``newer_than``, when given).  Raises
    ``ContractError`` or ``DuplicateKeyError`` before writing if the batch breaks the
    contract; ``keys_unique`` says that the batch cannot repeat a key.  ``slots`` a
    day and hash ``parts`` a slot are fixed when the table is made.
    """
    path = path.rstrip("/")
    last = current(spark, path)
    if last is not None:
        slots, parts = last.slots, last.parts
    # the batch feeds the checks, the counts and the merge: computed once
    scratch = fresh_path(spark, "serving-batch")
    batch.select(*contract.columns, *partition_columns(contract, slots, parts)).write.parquet(scratch)
    rows = spark.read.parquet(scratch)
    try:
        enforce_contract(rows, contract, keys_unique=keys_unique)
        counts = _merge(spark, path, rows, contract, newer_than, last, slots, parts, scratch)
    finally:
        discard(spark, scratch)
    return {k: int(v) for k, v in counts.items()}


def _merge(
    spark: SparkSession, path: str, rows: DataFrame, contract: TableContract, newer_than: str | None,
    last: Snapshot | None, slots: int, parts: int, scratch: str,
) -> dict[str, int]:
    n_rows = rows.count()
    old = None if last is not None else _unversioned(spark, path)
    if not n_rows and old is None:
        return {"inserted_count": 0, "updated_count": 0}
    kept = spark.createDataFrame([], MANIFEST)
    affected, n_affected, size = None, 0, size_of(spark, scratch)
    if last is not None:
        # hours of the batch, and of these the directories: metadata, however many rows there are
        touched = spark.createDataFrame(rows.select(*PARTITION).distinct().collect(), "key_date date, key_slot int, key_part int")
        manifest = last.manifest(spark)
        replaced = manifest.join(touched, PARTITION, "left_semi").collect()
        kept = manifest.join(touched, PARTITION, "left_anti")
        if replaced:
            affected, n_affected = _read(spark, last, replaced, contract), sum(p.rows for p in replaced)
            size += sum(size_of(spark, d) for d in _directories(path, replaced))
    elif old is not None:  # the first publish moves the whole table to the present layout
        affected = old.select(*contract.columns, *partition_columns(contract, slots, parts))
        n_affected, size = affected.count(), size + size_of(spark, path)
    keys = [*contract.keys, *PARTITION]
    counts = {}
    merged = rows
    if affected is not None:
        if newer_than is not None:
            counts = merge_counts(affected, rows, keys, newer_than=newer_than).first().asDict()
        merged = upsert(affected, rows, keys, [*contract.columns, *PARTITION], newer_than=newer_than)
    version = f"_{uuid4().hex[:16]}"
    stats = _write_version(spark, path, merged, version, report_column(contract), few_tasks(spark, size))
    if not counts:
        # merged = (affected - updated) + batch, so the counts follow from row counts
        inserted = int(stats.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]) - n_affected
        counts = {"inserted_count": inserted, "updated_count": n_rows - inserted}
    commit(spark, path, kept.unionByName(stats), version, last, slots, parts)
    if old is not None:
        for name in names(spark, path):
            if name.startswith(f"{KEY_DATE}=") or name == "_SUCCESS":
                discard(spark, f"{path}/{name}")
    vacuum(spark, path)
    return counts


def _write_version(
    spark: SparkSession, path: str, merged: DataFrame, version: str, report: str, tasks: int | None
) -> DataFrame:
    """Write the merged partitions as a version; returns their manifest rows."""
    root = f"{path}/data/{VERSION}={version}"
    write_partitioned(merged, root, PARTITION, mode="overwrite", tasks=tasks)
    kinds = "key_date date, key_slot int, key_part int"
    written = spark.read.schema(f"{report} timestamp_ntz, {kinds}").parquet(root)
    stats = written.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("rows"), F.min(report).alias("oldest"), F.max(report).alias("newest"))
    return stats.select(F.lit(version).alias(VERSION), *stats.columns)


def commit(
    spark: SparkSession, path: str, manifest: DataFrame, version: str, last: Snapshot | None, slots: int, parts: int
) -> None:
    """Write the manifest and make it the current one, in one step."""
    manifest.coalesce(1).write.parquet(f"{path}/manifests/{version}")
    number = max((n for n, _ in _entries(spark, path)), default=-1) + 1
    newest = current(spark, path)
    if newest is not None and (last is None or newest.number != last.number):
        raise RuntimeError(f"{path} was published by another writer meanwhile")
    create_new(spark, f"{path}/log/_{number:010d}", json.dumps({"manifest": version, "slots": slots, "parts": parts}))


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove what no kept version refers to: replaced partitions, and what dead publishes left."""
    path = path.rstrip("/")
    known = snapshots(spark, path)
    kept, dropped = known[-keep:], known[:-keep]
    if not kept:
        return

    def partitions(some: list[Snapshot]) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(*[f"{path}/manifests/{s.manifest_id}" for s in some]).select(VERSION, *PARTITION).distinct()

    live = partitions(kept)
    versions = {r.version for r in live.select(VERSION).distinct().collect()}
    for name in names(spark, f"{path}/data"):
        if name.startswith(f"{VERSION}=") and name.split("=", 1)[1] not in versions:
            discard(spark, f"{path}/data/{name}")
    if dropped:
        gone = partitions(dropped).join(live, [VERSION, *PARTITION], "left_anti").collect()
        for directory in _directories(path, [p for p in gone if p.version in versions]):
            discard(spark, directory)
    manifests = {s.manifest_id for s in kept}
    for name in names(spark, f"{path}/manifests"):
        if name not in manifests:
            discard(spark, f"{path}/manifests/{name}")
    entries = {name for number, name in _entries(spark, path) if number in {s.number for s in kept}}
    for name in names(spark, f"{path}/log"):
        if name not in entries:
            discard(spark, f"{path}/log/{name}")


def upsert_serving_runs(
    spark: SparkSession,
    path: str,
    history: DataFrame,
    contract: TableContract,
    order: Sequence[str],
    **layout: int,
) -> dict[str, int]:
    """Publish several runs at once: the last run (by ``order``) wins per key,
    exactly as if the runs had been upserted one after another."""
    latest = fold_latest(history, contract.keys, order, contract.columns)
    return upsert_serving(spark, path, latest, contract, keys_unique=True, **layout)


def register_serving_views(
    spark: SparkSession, paths: dict[str, str], contracts: dict[str, TableContract]
) -> list[str]:
    """Expose serving tables as temporary views named after their contracts, so
    consumer SQL (``SELECT .. FROM gold_flight_positions ORDER BY ..``) runs as is.
    A view stays with the version it was made from; register again after a publish."""
    found = []
    for name, path in paths.items():
        df = read_serving(spark, path, contracts[name])
        if df is not None:
            df.select(*contracts[name].columns).createOrReplaceTempView(name)
            found.append(name)
    return found
