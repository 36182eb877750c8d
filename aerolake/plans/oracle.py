"""Independent SQL formulation of every registered query (DuckDB dialect).

Computed directly from ``events`` / ``orders`` – never from the JSON documents –
so the VARIANT decode path is checked against plain column arithmetic.  The
adapter rules are those of ``aerolake.sources.events_adapter``.
"""

from __future__ import annotations

SILVER_COLS = (
    "aircraft_code, flight_callsign, country_of_origin, latitude, longitude, velocity, heading, "
    "vertical_rate, barometric_altitude_m, geometric_altitude_m, is_on_ground, position_timestamp, "
    "last_contact_timestamp, snapshot_timestamp, ingested_at, position_source, squawk, spi, sensors, "
    "source_file_path, snapshot_date, snapshot_hour"
)
GOLD_POS_COLS = (
    "aircraft_code, flight_callsign, country_of_origin, latitude, longitude, velocity, heading, "
    "vertical_rate, barometric_altitude_m, geometric_altitude_m, is_on_ground, position_timestamp, "
    "last_contact_timestamp, snapshot_timestamp, ingested_at, snapshot_date, snapshot_hour"
)
METRIC_COLS = (
    "snapshot_timestamp, snapshot_date, snapshot_hour, country_of_origin, total_flights, "
    "airborne_flights, grounded_flights, avg_velocity, avg_barometric_altitude_m, "
    "max_geometric_altitude_m"
)

_EV = """
ev AS (
  SELECT event_id AS e, user_id AS u, event_type AS et, value AS val,
         epoch_us(date_trunc('hour', ts)) // 1000000 AS hu,
         epoch_us(ts) // 1000000 AS su
  FROM events
)"""

_RAW = """
raw AS (
  SELECT
    CASE WHEN e % 61 = 0 THEN 'short' || CAST(e AS VARCHAR)
         WHEN e % 41 = 0 THEN NULL WHEN e % 43 = 0 THEN '   '
         ELSE ' ' || lower(hex(u)) || ' ' END AS icao24,
    CASE WHEN e % 61 = 0 THEN NULL ELSE upper(et) || '  ' END AS callsign,
    CASE WHEN e % 61 = 0 OR u % 25 = 7 THEN NULL
         ELSE 'NATION_' || CAST(u % 25 AS VARCHAR) || ' ' END AS origin_country,
    CASE WHEN e % 61 = 0 THEN hu WHEN e % 47 = 0 THEN NULL
         WHEN e % 13 = 0 THEN hu - 3600 ELSE hu END AS time_position_unix,
    su AS last_contact_unix,
    CASE WHEN e % 61 = 0 OR e % 53 = 0 THEN NULL
         ELSE CAST(e % 400 - 200 AS DOUBLE) + 0.5 END AS longitude,
    CASE WHEN e % 61 = 0 THEN NULL ELSE CAST(e % 200 - 100 AS DOUBLE) + 0.25 END AS latitude,
    CASE WHEN e % 61 = 0 OR e % 59 = 0 THEN NULL ELSE val END AS baro_altitude,
    CASE WHEN e % 61 = 0 THEN NULL WHEN et IN ('view', 'signup') THEN TRUE
         WHEN et = 'error' THEN NULL ELSE FALSE END AS on_ground,
    CASE WHEN e % 61 = 0 THEN NULL ELSE val END AS velocity,
    CASE WHEN e % 61 = 0 THEN NULL ELSE CAST(e % 360 AS DOUBLE) END AS heading,
    CAST(NULL AS DOUBLE) AS vertical_rate,
    CASE WHEN e % 61 = 0 OR e % 5 <> 0 THEN NULL
         ELSE '[' || CAST(e % 7 AS VARCHAR) || ',9]' END AS sensors,
    CASE WHEN e % 61 = 0 THEN NULL ELSE CAST(u AS DOUBLE) * 1.5 END AS geo_altitude,
    CASE WHEN e % 61 = 0 THEN NULL ELSE lpad(CAST(e % 7777 AS VARCHAR), 4, '0') END AS squawk,
    CASE WHEN e % 61 = 0 THEN NULL ELSE FALSE END AS spi,
    CASE WHEN e % 61 = 0 THEN NULL ELSE e % 4 END AS position_source,
    CASE WHEN (hu // 3600) % 11 = 0 THEN NULL ELSE hu + 3600 END AS api_snapshot_time_unix,
    hu + 7200 AS record_timestamp_unix,
    'snap_' || CAST(hu AS VARCHAR) AS source_file_path,
    e AS state_ordinal
  FROM ev
  WHERE e % 67 <> 0
)"""

_TYPED = """
typed AS (
  SELECT
    trim(icao24) AS aircraft_code, trim(callsign) AS flight_callsign,
    trim(origin_country) AS country_of_origin,
    latitude, longitude, velocity, heading, vertical_rate,
    baro_altitude AS barometric_altitude_m, geo_altitude AS geometric_altitude_m,
    on_ground AS is_on_ground,
    make_timestamp(time_position_unix * 1000000) AS position_timestamp,
    make_timestamp(last_contact_unix * 1000000) AS last_contact_timestamp,
    make_timestamp(api_snapshot_time_unix * 1000000) AS snapshot_timestamp,
    make_timestamp(record_timestamp_unix * 1000000) AS ingested_at,
    position_source, squawk, spi, sensors, source_file_path,
    CAST(make_timestamp(record_timestamp_unix * 1000000) AS DATE) AS snapshot_date,
    CAST(hour(make_timestamp(record_timestamp_unix * 1000000)) AS INTEGER) AS snapshot_hour,
    state_ordinal
  FROM raw
)"""

_CHECKS = """
checked AS (
  SELECT *,
    CASE WHEN aircraft_code IS NULL THEN 'null_aircraft_code'
         WHEN aircraft_code = '' THEN 'blank_aircraft_code'
         WHEN position_timestamp IS NULL THEN 'null_position_timestamp'
         WHEN NOT (latitude BETWEEN -90 AND 90 OR latitude IS NULL) THEN 'latitude_out_of_range'
         WHEN NOT (longitude BETWEEN -180 AND 180 OR longitude IS NULL) THEN 'longitude_out_of_range'
    END AS reject_reason
  FROM typed
),
valid AS (SELECT * EXCLUDE (reject_reason) FROM checked WHERE reject_reason IS NULL),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY ingested_at, aircraft_code, position_timestamp
      ORDER BY last_contact_timestamp DESC NULLS LAST, state_ordinal) AS rn
    FROM valid) WHERE rn = 1
)"""

_METRICS = """
metrics_run AS (
  SELECT coalesce(snapshot_timestamp, ingested_at) AS snapshot_timestamp,
         snapshot_date, snapshot_hour,
         coalesce(country_of_origin, 'UNKNOWN') AS country_of_origin,
         ingested_at,
         count(*) AS total_flights,
         CAST(sum(CASE WHEN is_on_ground = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS airborne_flights,
         CAST(sum(CASE WHEN is_on_ground = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS grounded_flights,
         round(avg(velocity), 6) AS avg_velocity,
         round(avg(barometric_altitude_m), 6) AS avg_barometric_altitude_m,
         max(geometric_altitude_m) AS max_geometric_altitude_m
  FROM silver
  GROUP BY 1, 2, 3, 4, 5
),
serving_positions AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT {gp}, row_number() OVER (
      PARTITION BY aircraft_code, position_timestamp
      ORDER BY ingested_at DESC, source_file_path DESC) AS rn
    FROM silver) WHERE rn = 1
),
serving_metrics AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT {mc}, row_number() OVER (
      PARTITION BY snapshot_timestamp, country_of_origin ORDER BY ingested_at DESC) AS rn
    FROM metrics_run) WHERE rn = 1
)""".format(gp=GOLD_POS_COLS, mc=METRIC_COLS)

FLIGHT_CTES = "WITH " + ",".join([_EV, _RAW, _TYPED, _CHECKS, _METRICS]) + "\n"

_ORDERS = """
WITH target AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0),
batch AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
),
plain_batch AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
"""

RAW_COLS = (
    "icao24, callsign, origin_country, time_position_unix, last_contact_unix, longitude, latitude, "
    "baro_altitude, on_ground, velocity, heading, vertical_rate, sensors, geo_altitude, squawk, spi, "
    "position_source, api_snapshot_time_unix, record_timestamp_unix, source_file_path"
)

# Bronze directories are in local time of America/Recife, UTC-3 all through the data period.
_RECIFE_OFFSET_S = -3 * 3600


def _flight(body: str) -> str:
    return FLIGHT_CTES + body


def _violations() -> str:
    pos_rules = [
        ("not_null:aircraft_code", "count_if(aircraft_code IS NULL)"),
        ("not_null:position_timestamp", "count_if(position_timestamp IS NULL)"),
        ("not_null:ingested_at", "count_if(ingested_at IS NULL)"),
        ("not_null:snapshot_date", "count_if(snapshot_date IS NULL)"),
        ("not_null:snapshot_hour", "count_if(snapshot_hour IS NULL)"),
        ("max_len:aircraft_code", "count_if(length(aircraft_code) > 10)"),
        ("max_len:flight_callsign", "count_if(length(flight_callsign) > 20)"),
        ("max_len:country_of_origin", "count_if(length(country_of_origin) > 100)"),
    ]
    met_rules = [
        ("not_null:snapshot_timestamp", "count_if(snapshot_timestamp IS NULL)"),
        ("not_null:snapshot_date", "count_if(snapshot_date IS NULL)"),
        ("not_null:snapshot_hour", "count_if(snapshot_hour IS NULL)"),
        ("not_null:country_of_origin", "count_if(country_of_origin IS NULL)"),
        ("not_null:total_flights", "count_if(total_flights IS NULL)"),
        ("not_null:airborne_flights", "count_if(airborne_flights IS NULL)"),
        ("not_null:grounded_flights", "count_if(grounded_flights IS NULL)"),
        ("max_len:country_of_origin", "count_if(length(country_of_origin) > 100)"),
    ]
    parts = []
    for label, src, rules, keys in [
        ("gold_flight_positions@typed", "typed", pos_rules, "aircraft_code, position_timestamp"),
        ("gold_flight_positions", "silver", pos_rules, "aircraft_code, position_timestamp"),
        ("gold_country_metrics", "metrics_run", met_rules, "snapshot_timestamp, country_of_origin"),
    ]:
        for rule, expr in rules:
            parts.append(
                f"SELECT '{label}' AS table_name, '{rule}' AS rule, "
                f"CAST({expr} AS BIGINT) AS violations FROM {src}"
            )
        parts.append(
            f"SELECT '{label}' AS table_name, 'unique_key' AS rule, CAST(count(*) AS BIGINT) "
            f"AS violations FROM (SELECT ingested_at, {keys} FROM {src} "
            f"GROUP BY ingested_at, {keys} HAVING count(*) > 1)"
        )
    return _flight("\nUNION ALL\n".join(parts))


_GROUPED = """
SELECT coalesce(snapshot_timestamp, ingested_at) AS snapshot_timestamp, snapshot_date, snapshot_hour,
       coalesce(country_of_origin, 'UNKNOWN') AS country_of_origin,
       count(*) AS total_flights,
       CAST(sum(CASE WHEN is_on_ground = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS airborne_flights,
       CAST(sum(CASE WHEN is_on_ground = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS grounded_flights,
       round(avg(velocity), 6) AS avg_velocity,
       round(avg(barometric_altitude_m), 6) AS avg_barometric_altitude_m,
       max(geometric_altitude_m) AS max_geometric_altitude_m
FROM ({rows}) GROUP BY 1, 2, 3, 4
"""

# the same snapshots half an hour later, and all of them as one run at a fixed instant
_TWO_RUNS = (
    "SELECT * FROM silver UNION ALL "
    "SELECT * REPLACE (ingested_at + INTERVAL 30 MINUTE AS ingested_at) FROM silver"
)
_LIVE = "make_timestamp(CAST(1716084000 AS BIGINT) * 1000000)"
_ONE_RUN = (
    f"SELECT * REPLACE ({_LIVE} AS ingested_at, CAST({_LIVE} AS DATE) AS snapshot_date, "
    f"CAST(hour({_LIVE}) AS INTEGER) AS snapshot_hour) FROM silver"
)

_TEXTS = """
WITH ev AS (SELECT event_id AS e, epoch_us(date_trunc('hour', ts)) // 1000000 AS hu FROM events),
texts AS (
  SELECT hu + 7200 AS run, e % 97 = 0 AS cut,
         '{"time": ' || hu || ', "feed": "f' || e || '", "states": [["c' || e || '"]]}' AS whole
  FROM ev
)
"""


_RUN = "epoch_us(ingested_at) // 1000000"
_RUN_TABLE = f"""
SELECT r.run, coalesce(states, 0) AS states, coalesce(rejected, 0) AS rejected, coalesce(kept, 0) AS kept, CAST(0 AS BIGINT) AS quarantined
FROM (SELECT DISTINCT hu + 7200 AS run FROM ev) r
LEFT JOIN (SELECT {_RUN} AS run, count(*) AS states, count(reject_reason) AS rejected FROM checked GROUP BY 1) c ON c.run = r.run
LEFT JOIN (SELECT {_RUN} AS run, count(*) AS kept FROM silver GROUP BY 1) s ON s.run = r.run
"""


def oracle_queries() -> dict[str, str]:
    stream_cols = SILVER_COLS.replace("source_file_path, ", "")
    raw_cols = RAW_COLS.replace(", source_file_path", "")
    run_time = "make_timestamp(run * 1000000)"
    local = f"make_timestamp((hu + 7200 + ({_RECIFE_OFFSET_S})) * 1000000)"
    latest = "SELECT * FROM serving_positions ORDER BY ingested_at DESC, aircraft_code, position_timestamp LIMIT 20"
    busiest = "SELECT * FROM serving_metrics ORDER BY snapshot_timestamp DESC, total_flights DESC, country_of_origin LIMIT 20"
    counts = (
        "SELECT 'gold_flight_positions' AS table_name, count(*) AS row_count FROM serving_positions "
        "UNION ALL SELECT 'gold_country_metrics', count(*) FROM serving_metrics"
    )
    return {
        "bronze_states_decode": _flight(f"SELECT {RAW_COLS} FROM raw"),
        "silver_typed_projection": _flight(f"SELECT {SILVER_COLS} FROM typed"),
        "silver_validity_filter": _flight(f"SELECT {SILVER_COLS} FROM valid"),
        "silver_rejects": _flight(f"SELECT {SILVER_COLS}, reject_reason FROM checked "
                                  "WHERE reject_reason IS NOT NULL"),
        "silver_dedup_positions": _flight(
            "SELECT ingested_at, aircraft_code, position_timestamp, last_contact_timestamp, "
            "flight_callsign, latitude, longitude FROM silver"),
        "silver_flight_positions": _flight(f"SELECT {SILVER_COLS} FROM silver"),
        "gold_flight_positions": _flight(f"SELECT {GOLD_POS_COLS} FROM silver"),
        "gold_country_metrics": _flight(_GROUPED.format(rows="SELECT * FROM silver")),
        "ground_state_counts": _flight(
            "SELECT snapshot_date, snapshot_hour, count(*) AS total_flights, "
            "CAST(sum(CASE WHEN is_on_ground = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS airborne_flights, "
            "CAST(sum(CASE WHEN is_on_ground = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS grounded_flights, "
            "count_if(is_on_ground IS NULL) AS unknown_ground_state "
            "FROM silver GROUP BY snapshot_date, snapshot_hour"),
        "serving_fold_positions": _flight("SELECT * FROM serving_positions"),
        "serving_fold_metrics": _flight("SELECT * FROM serving_metrics"),
        "latest_positions_topk": _flight(latest),
        "serving_latest_positions": _flight(latest),
        "busiest_countries_topk": _flight(busiest),
        "serving_busiest_countries": _flight(busiest),
        "serving_row_counts": _flight(counts),
        "serving_manifest_counts": _flight(counts),
        "bronze_default_mixed_formats": _flight(f"SELECT {stream_cols} FROM silver"),
        "lake_rejects": _flight(f"SELECT {stream_cols}, reject_reason FROM checked WHERE reject_reason IS NOT NULL"),
        "lake_run_table": _flight(_RUN_TABLE),
        "stamped_run_emptied": _flight(
            f"SELECT {GOLD_POS_COLS} FROM silver WHERE (epoch_us(ingested_at) // 3600000000) % 5 <> 0"),
        "incremental_far_late_run": _flight(f"SELECT {stream_cols} FROM silver"),
        "contract_violations": _violations(),
        "upsert_result": _ORDERS + (
            "SELECT t.* FROM target t WHERE NOT EXISTS "
            "(SELECT 1 FROM batch b WHERE b.o_orderkey = t.o_orderkey) "
            "UNION ALL SELECT * FROM batch"),
        "upsert_counts": _ORDERS + (
            "SELECT count_if(t.o_orderkey IS NULL) AS inserted_count, "
            "count_if(t.o_orderkey IS NOT NULL) AS updated_count "
            "FROM batch b LEFT JOIN target t ON b.o_orderkey = t.o_orderkey"),
        "insert_ignore_result": _ORDERS + (
            "SELECT * FROM target UNION ALL SELECT b.* FROM plain_batch b WHERE NOT EXISTS ("
            "SELECT 1 FROM target t WHERE t.o_orderkey IS NOT DISTINCT FROM b.o_orderkey "
            "AND t.o_custkey IS NOT DISTINCT FROM b.o_custkey "
            "AND t.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus "
            "AND t.o_totalprice IS NOT DISTINCT FROM b.o_totalprice "
            "AND t.o_orderdate IS NOT DISTINCT FROM b.o_orderdate "
            "AND t.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority)"),
        "insert_ignore_duplicates": _ORDERS + (
            "SELECT * FROM target UNION ALL "
            "(SELECT * FROM plain_batch EXCEPT SELECT * FROM target)"),
        "gold_country_metrics_two_runs": _flight(_GROUPED.format(rows=_TWO_RUNS)),
        "live_run_rerun": _flight(_GROUPED.format(rows=_ONE_RUN)),
        "bronze_hour_scan": _flight(
            f"SELECT {raw_cols} FROM raw "
            "WHERE record_timestamp_unix = (SELECT min(hu) + 7200 FROM ev)"),
        "bronze_multiline_decode": _flight(f"SELECT {raw_cols} FROM raw"),
        "bronze_land_texts": _TEXTS + (
            "SELECT CASE WHEN cut THEN substr(whole, 1, 20) ELSE whole END AS value, "
            f"CAST(year({run_time}) AS INTEGER) AS year, CAST(month({run_time}) AS INTEGER) AS month, "
            f"CAST(day({run_time}) AS INTEGER) AS day, CAST(hour({run_time}) AS INTEGER) AS hour FROM texts"),
        "bronze_corrupt_documents": _TEXTS + (
            "SELECT run AS record_timestamp_unix, substr(whole, 1, 20) AS document FROM texts WHERE cut"),
        "bronze_replay_silver": _flight(f"SELECT {stream_cols} FROM silver"),
        "bronze_replay_after_correction": _flight(
            f"SELECT {GOLD_POS_COLS} FROM silver WHERE (epoch_us(ingested_at) // 3600000000) % 5 <> 0"),
        "incremental_split_run": _flight(f"SELECT {stream_cols} FROM silver"),
        "incremental_late_run": _flight(f"SELECT {stream_cols} FROM silver"),
        "bronze_partition_scan": (
            f"WITH ev AS (SELECT event_id AS e, epoch_us(date_trunc('hour', ts)) // 1000000 AS hu "
            f"FROM events), loc AS (SELECT e, hu, {local} AS lt FROM ev) "
            "SELECT CAST(year(lt) AS INTEGER) AS year, CAST(month(lt) AS INTEGER) AS month, "
            "CAST(day(lt) AS INTEGER) AS day, CAST(hour(lt) AS INTEGER) AS hour, "
            "count(DISTINCT (hu, e // 10000)) AS documents, count(*) AS state_entries "
            "FROM loc GROUP BY 1, 2, 3, 4"),
        "silver_partition_roundtrip": _flight(f"SELECT {SILVER_COLS} FROM silver"),
        "silver_append_rerun": _flight(
            f"SELECT {SILVER_COLS} FROM silver UNION ALL SELECT {SILVER_COLS} FROM silver"),
        "silver_replace_rerun": _flight(f"SELECT {SILVER_COLS} FROM silver"),
        "gold_partition_roundtrip": _flight(_GROUPED.format(rows="SELECT * FROM silver")),
        "bronze_replay": _flight(f"SELECT {METRIC_COLS} FROM metrics_run"),
        "serving_upsert_positions": _flight("SELECT * FROM serving_positions"),
        "serving_upsert_metrics": _flight("SELECT * FROM serving_metrics"),
        "incremental_silver": _flight(f"SELECT {stream_cols} FROM silver"),
    }
