"""Silver layer: typed projection, validity rules, rejects and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.contracts import SILVER_COLUMNS
from aerolake.functions.time import epoch_to_ntz

DEDUP_KEYS: tuple[str, ...] = ("aircraft_code", "position_timestamp")


def run_scope() -> list[Column]:
    """What one run's snapshot is: the ingest instant and the snapshot document.

    The parts of a landed snapshot share a ``snapshot=`` directory and count as one
    document; any other file is a document of its own, also under an equal instant.
    """
    path = F.col("source_file_path")
    return [F.col("ingested_at"), F.regexp_replace(path, r"(/snapshot=[^/]+)/[^/]*$", "$1")]


def typed_positions(raw: DataFrame) -> DataFrame:
    """Raw table -> Silver columns (+ ``state_ordinal``), before any filter.

    Text is trimmed (spaces only), epoch seconds become UTC ``TIMESTAMP_NTZ``,
    three columns are renamed, and the lake partition is the *ingest* date/hour.
    """
    ingested = epoch_to_ntz("record_timestamp_unix")
    return raw.select(
        F.trim("icao24").alias("aircraft_code"),
        F.trim("callsign").alias("flight_callsign"),
        F.trim("origin_country").alias("country_of_origin"),
        "latitude",
        "longitude",
        "velocity",
        "heading",
        "vertical_rate",
        F.col("baro_altitude").alias("barometric_altitude_m"),
        F.col("geo_altitude").alias("geometric_altitude_m"),
        F.col("on_ground").alias("is_on_ground"),
        epoch_to_ntz("time_position_unix").alias("position_timestamp"),
        epoch_to_ntz("last_contact_unix").alias("last_contact_timestamp"),
        epoch_to_ntz("api_snapshot_time_unix").alias("snapshot_timestamp"),
        ingested.alias("ingested_at"),
        "position_source",
        "squawk",
        "spi",
        "sensors",
        "source_file_path",
        F.to_date(ingested).alias("snapshot_date"),
        F.hour(ingested).alias("snapshot_hour"),
        "state_ordinal",
    )


# Validity rules in the order they are checked: (reason code, condition that must hold).
def _rules() -> list[tuple[str, Column]]:
    code, lat, lon = F.col("aircraft_code"), F.col("latitude"), F.col("longitude")
    return [
        ("null_aircraft_code", code.isNotNull()),
        ("blank_aircraft_code", code != ""),
        ("null_position_timestamp", F.col("position_timestamp").isNotNull()),
        ("latitude_out_of_range", lat.between(-90.0, 90.0) | lat.isNull()),
        ("longitude_out_of_range", lon.between(-180.0, 180.0) | lon.isNull()),
    ]


def validity_condition() -> Column:
    """All rules hold (a NULL rule result counts as failed)."""
    cond = F.lit(True)
    for _, rule in _rules():
        cond = cond & F.coalesce(rule, F.lit(False))
    return cond


def reject_reason() -> Column:
    """Code of the first failed rule, NULL for a valid row."""
    expr = None
    for reason, rule in _rules():
        failed = ~F.coalesce(rule, F.lit(False))
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return expr


def valid_positions(typed: DataFrame) -> DataFrame:
    return typed.where(validity_condition())


def rejected_positions(typed: DataFrame) -> DataFrame:
    """Complement of ``valid_positions`` with the reason of each drop."""
    return typed.select("*", reject_reason().alias("reject_reason")).where(
        F.col("reject_reason").isNotNull()
    )


def dedup_positions(
    valid: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    scope: Sequence[Column] | None = None,
) -> DataFrame:
    """Keep one row per (run's snapshot, key): newest contact, then lowest state
    ordinal, then the first file.  ``scope`` replaces ``run_scope()``.

    ``row_number() = 1`` is planned as WindowGroupLimit (partial before the
    shuffle, final after), so a hot key is cut down on the map side.
    """
    w = Window.partitionBy(*(run_scope() if scope is None else scope), *keys).orderBy(
        F.col("last_contact_timestamp").desc_nulls_last(), F.col("state_ordinal").asc(), F.col("source_file_path").asc()
    )
    return (
        valid.select("*", F.row_number().over(w).alias("_rn"))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def silver_projection(df: DataFrame) -> DataFrame:
    """Ordered projection to the 22 Silver columns."""
    return df.select(*SILVER_COLUMNS)


def raw_to_silver(raw: DataFrame) -> DataFrame:
    """Raw table -> Silver (typed, valid, de-duplicated, contract order)."""
    return silver_projection(dedup_positions(valid_positions(typed_positions(raw))))
