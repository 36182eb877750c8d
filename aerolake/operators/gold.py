"""Gold layer: detail projection, per-country metrics, consumer top-k and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.contracts import GOLD_METRIC_COLUMNS, GOLD_POSITION_COLUMNS, UNKNOWN_COUNTRY
from aerolake.functions.columns import airborne_flag, grounded_flag


def gold_positions(silver: DataFrame) -> DataFrame:
    """Detail table: Silver without the five feed-internal columns."""
    return silver.select(*GOLD_POSITION_COLUMNS)


def country_metrics(
    silver: DataFrame,
    *,
    keep_run: bool = False,
    round_digits: int | None = None,
) -> DataFrame:
    """Per snapshot, ingest date/hour and country: counts, averages, maximum.

    The snapshot time falls back to the ingest time; a NULL country becomes
    ``UNKNOWN`` (an empty string stays its own group).  With ``keep_run`` groups
    are also formed per run (ingest instant) and ``ingested_at`` is kept, so a
    multi-run input yields what separate runs would, ready for a last-run-wins fold.
    Two-phase HashAggregate: a hot country is combined map-side.
    """
    avg_v = F.avg("velocity")
    avg_b = F.avg("barometric_altitude_m")
    if round_digits is not None:
        avg_v, avg_b = F.round(avg_v, round_digits), F.round(avg_b, round_digits)
    run = ["ingested_at"] if keep_run else []
    grouped = silver.select(
        F.coalesce("snapshot_timestamp", "ingested_at").alias("snapshot_timestamp"),
        "snapshot_date",
        "snapshot_hour",
        F.coalesce("country_of_origin", F.lit(UNKNOWN_COUNTRY)).alias("country_of_origin"),
        "ingested_at",
        "is_on_ground",
        "velocity",
        "barometric_altitude_m",
        "geometric_altitude_m",
    ).groupBy("snapshot_timestamp", "snapshot_date", "snapshot_hour", "country_of_origin", *run)
    metrics = grouped.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.sum(airborne_flag(F.col("is_on_ground"))).cast("bigint").alias("airborne_flights"),
        F.sum(grounded_flag(F.col("is_on_ground"))).cast("bigint").alias("grounded_flights"),
        avg_v.alias("avg_velocity"),
        avg_b.alias("avg_barometric_altitude_m"),
        F.max("geometric_altitude_m").alias("max_geometric_altitude_m"),
    )
    return metrics.select(*GOLD_METRIC_COLUMNS, *run)


def ground_state_counts(silver: DataFrame) -> DataFrame:
    """Airborne / grounded / unknown counts per ingest date and hour."""
    g = F.col("is_on_ground")
    return silver.groupBy("snapshot_date", "snapshot_hour").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.sum(airborne_flag(g)).cast("bigint").alias("airborne_flights"),
        F.sum(grounded_flag(g)).cast("bigint").alias("grounded_flights"),
        F.count_if(g.isNull()).alias("unknown_ground_state"),
    )


def latest_positions(positions: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` positions by ingest time (keys break ties) – a top-k report."""
    return positions.orderBy(
        F.col("ingested_at").desc(), F.col("aircraft_code").asc(), F.col("position_timestamp").asc()
    ).limit(n)


def busiest_countries(metrics: DataFrame, n: int = 20) -> DataFrame:
    """Latest snapshots first, busiest countries first – a top-k report."""
    return metrics.orderBy(
        F.col("snapshot_timestamp").desc(),
        F.col("total_flights").desc(),
        F.col("country_of_origin").asc(),
    ).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``(table_name, row_count)`` row per table, as a union of counts."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
