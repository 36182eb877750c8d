"""Bronze scan and positional decode (no Python row code).

A *document frame* has one row per snapshot document (or part of one):

* ``time`` BIGINT – feed time of the snapshot (may be NULL),
* ``states`` VARIANT – the positional state vectors,
* ``state_offset`` BIGINT – ordinal of the first state when a snapshot is split
  into parts (NULL means 0),
* ``source_file_path`` STRING – provenance,
* ``record_timestamp_unix`` BIGINT – run (ingest) instant in epoch seconds.

``read_bronze`` builds it from landed files; ``snapshot_documents`` builds it
from the ``events`` table.  ``decode_documents`` turns it into the raw table.
"""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.contracts import RAW_SCHEMA, STATE_POSITIONS
from aerolake.functions.columns import decode_position
from aerolake.functions.time import instant_from_path, ntz_to_epoch

BRONZE_READ_SCHEMA = "time BIGINT, states VARIANT, state_offset BIGINT, _corrupt_record STRING"

DOCUMENT_COLUMNS = ["time", "states", "state_offset", "source_file_path", "record_timestamp_unix"]


def read_bronze(
    spark: SparkSession,
    path: str | list[str],
    *,
    multi_line: bool = False,
    zone: str = "UTC",
    record_epoch: int | None = None,
) -> DataFrame:
    """Read landed snapshot documents from a file, directory or Bronze root.

    Hive-style ``year=/month=/day=/hour=`` directories become INT columns, so a
    ``where`` on them is a partition filter.  The run instant is ``record_epoch``
    when given (a live run), else it is parsed from the path stamp in ``zone``
    (replay); a path without a stamp then fails the job.  Malformed documents land
    in ``_corrupt_record`` and yield no states (see ``corrupt_documents``).

    ``multi_line=True`` reads one (indented) document per file, one task per
    file; ``False`` reads JSON Lines, as landed here, which Spark splits across tasks.
    ``plans.intake`` tells the format of each file and counts what was read.
    """
    raw = (
        spark.read.schema(BRONZE_READ_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )
    fp = F.col("_metadata.file_path")
    if record_epoch is None:
        run = stamped_run(fp, zone)
    else:
        run = F.lit(record_epoch).cast("bigint")
    return raw.select(
        "*",
        fp.alias("source_file_path"),
        run.alias("record_timestamp_unix"),
    )


def stamped_run(path: Column, zone: str = "UTC") -> Column:
    """Run instant (epoch s) of a path's stamp; a path without one fails the job, as
    rows without a run could be neither partitioned nor told apart."""
    missing = F.raise_error(F.concat(F.lit("no run instant in the path "), path)).cast("bigint")
    run = ntz_to_epoch(instant_from_path(path, zone))
    return F.when(run.isNull(), missing).otherwise(run)


def parse_documents(
    df: DataFrame,
    text_col: str = "value",
    *,
    source_col: str = "source_file_path",
    record_col: str = "record_timestamp_unix",
) -> DataFrame:
    """JSON text documents already in a column (e.g. from a text or queue
    source) -> document frame.  Text that is not valid JSON gives no states."""
    doc = F.try_parse_json(F.col(text_col))
    return df.select(
        F.try_variant_get(doc, "$.time", "bigint").alias("time"),
        F.try_variant_get(doc, "$.states", "variant").alias("states"),
        F.try_variant_get(doc, "$.state_offset", "bigint").alias("state_offset"),
        F.col(source_col).alias("source_file_path"),
        F.col(record_col).cast("bigint").alias("record_timestamp_unix"),
    )


def bronze_partition(instant_utc: datetime, zone: str = "UTC") -> Column:
    """Partition predicate selecting the Bronze hour of a run instant.

    The directories hold the local date/hour in ``zone``; used in a ``where``
    on ``read_bronze`` output it becomes a ``PartitionFilters`` entry, so only
    that hour's files are listed and read.
    """
    local = instant_utc.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone))
    return (
        (F.col("year") == local.year)
        & (F.col("month") == local.month)
        & (F.col("day") == local.day)
        & (F.col("hour") == local.hour)
    )


def corrupt_documents(docs: DataFrame) -> DataFrame:
    """Documents that could not be parsed, with file and run, for quarantine.

    (``states`` is referenced too: Spark refuses a JSON scan whose only
    column is the corrupt-record column.)
    """
    return docs.where(is_corrupt()).select(
        "source_file_path", "record_timestamp_unix", "_corrupt_record"
    )


def is_corrupt() -> Column:
    return F.col("_corrupt_record").isNotNull() & F.col("states").isNull()


def _is_list(value: Column) -> Column:
    # An entry is used only if it is a JSON array (an empty one included).
    return F.try_variant_get(value, "$", "array<variant>").isNotNull()


def explode_states(docs: DataFrame) -> DataFrame:
    """One row per list-shaped state vector; other entries are skipped.

    ``states`` that is NULL, missing, JSON null or not an array gives no rows.
    ``state_ordinal`` is the position within the snapshot (plus ``state_offset``).
    """
    exploded = docs.select(
        F.col("time").alias("api_snapshot_time_unix"),
        "record_timestamp_unix",
        "source_file_path",
        F.coalesce(F.col("state_offset"), F.lit(0)).alias("_offset"),
        F.posexplode(F.try_variant_get(F.col("states"), "$", "array<variant>")).alias(
            "_pos", "value"
        ),
    )
    return exploded.where(_is_list(F.col("value"))).select(
        "api_snapshot_time_unix",
        "record_timestamp_unix",
        "source_file_path",
        (F.col("_offset") + F.col("_pos")).alias("state_ordinal"),
        "value",
    )


def decode_states(states: DataFrame, *, strict: bool = False) -> DataFrame:
    """Positional VARIANT vectors -> the 20 typed raw columns + ``state_ordinal``.

    Missing positions are NULL and extra ones ignored.  ``strict`` makes a value
    that cannot be cast fail the job instead of becoming NULL.
    """
    v = F.col("value")
    decoded = [
        decode_position(v, i, kind, strict).alias(name) for i, name, kind in STATE_POSITIONS
    ]
    return states.select(
        *decoded,
        "api_snapshot_time_unix",
        "record_timestamp_unix",
        "source_file_path",
        "state_ordinal",
    )


def decode_documents(docs: DataFrame, *, strict: bool = False) -> DataFrame:
    """Document frame -> raw table (RAW_SCHEMA order) + ``state_ordinal``."""
    raw = decode_states(explode_states(docs), strict=strict)
    return raw.select(*[f.name for f in RAW_SCHEMA.fields], "state_ordinal")
