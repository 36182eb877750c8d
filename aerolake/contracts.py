"""Table contracts: schemas, positional decode map, keys and column rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# --- Fixed values that must equal the feed's layout -------------------------
# Positional layout of one state vector (index, raw column, decoded type).
# "json" marks a nested value that is kept as compact JSON text.
STATE_POSITIONS: list[tuple[int, str, str]] = [
    (0, "icao24", "string"),
    (1, "callsign", "string"),
    (2, "origin_country", "string"),
    (3, "time_position_unix", "bigint"),
    (4, "last_contact_unix", "bigint"),
    (5, "longitude", "double"),
    (6, "latitude", "double"),
    (7, "baro_altitude", "double"),
    (8, "on_ground", "boolean"),
    (9, "velocity", "double"),
    (10, "heading", "double"),
    (11, "vertical_rate", "double"),
    (12, "sensors", "json"),
    (13, "geo_altitude", "double"),
    (14, "squawk", "string"),
    (15, "spi", "boolean"),
    (16, "position_source", "bigint"),
]

# Column lists of the three lake tables, in contract order.
SILVER_COLUMNS: list[str] = [
    "aircraft_code",
    "flight_callsign",
    "country_of_origin",
    "latitude",
    "longitude",
    "velocity",
    "heading",
    "vertical_rate",
    "barometric_altitude_m",
    "geometric_altitude_m",
    "is_on_ground",
    "position_timestamp",
    "last_contact_timestamp",
    "snapshot_timestamp",
    "ingested_at",
    "position_source",
    "squawk",
    "spi",
    "sensors",
    "source_file_path",
    "snapshot_date",
    "snapshot_hour",
]

GOLD_POSITION_COLUMNS: list[str] = [
    "aircraft_code",
    "flight_callsign",
    "country_of_origin",
    "latitude",
    "longitude",
    "velocity",
    "heading",
    "vertical_rate",
    "barometric_altitude_m",
    "geometric_altitude_m",
    "is_on_ground",
    "position_timestamp",
    "last_contact_timestamp",
    "snapshot_timestamp",
    "ingested_at",
    "snapshot_date",
    "snapshot_hour",
]

GOLD_METRIC_COLUMNS: list[str] = [
    "snapshot_timestamp",
    "snapshot_date",
    "snapshot_hour",
    "country_of_origin",
    "total_flights",
    "airborne_flights",
    "grounded_flights",
    "avg_velocity",
    "avg_barometric_altitude_m",
    "max_geometric_altitude_m",
]

# Serving-table rules: keys, NOT NULL columns and VARCHAR limits.
POSITION_KEYS: list[str] = ["aircraft_code", "position_timestamp"]
METRIC_KEYS: list[str] = ["snapshot_timestamp", "country_of_origin"]
POSITION_NOT_NULL: list[str] = [
    "aircraft_code",
    "position_timestamp",
    "ingested_at",
    "snapshot_date",
    "snapshot_hour",
]
POSITION_MAX_LEN: dict[str, int] = {
    "aircraft_code": 10,
    "flight_callsign": 20,
    "country_of_origin": 100,
}
METRIC_NOT_NULL: list[str] = [
    "snapshot_timestamp",
    "snapshot_date",
    "snapshot_hour",
    "country_of_origin",
    "total_flights",
    "airborne_flights",
    "grounded_flights",
]
METRIC_MAX_LEN: dict[str, int] = {"country_of_origin": 100}

LAKE_PARTITION_COLUMNS: list[str] = ["snapshot_date", "snapshot_hour"]
BRONZE_PARTITION_COLUMNS: list[str] = ["year", "month", "day", "hour"]
UNKNOWN_COUNTRY = "UNKNOWN"
# ---------------------------------------------------------------------------

_SQL_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "json": StringType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
}

RAW_SCHEMA = StructType(
    [StructField(name, _SQL_TYPES[kind], True) for _, name, kind in STATE_POSITIONS]
    + [
        StructField("api_snapshot_time_unix", LongType(), True),
        StructField("record_timestamp_unix", LongType(), False),
        StructField("source_file_path", StringType(), False),
    ]
)

SILVER_SCHEMA = StructType(
    [
        StructField("aircraft_code", StringType()),
        StructField("flight_callsign", StringType()),
        StructField("country_of_origin", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("velocity", DoubleType()),
        StructField("heading", DoubleType()),
        StructField("vertical_rate", DoubleType()),
        StructField("barometric_altitude_m", DoubleType()),
        StructField("geometric_altitude_m", DoubleType()),
        StructField("is_on_ground", BooleanType()),
        StructField("position_timestamp", TimestampNTZType()),
        StructField("last_contact_timestamp", TimestampNTZType()),
        StructField("snapshot_timestamp", TimestampNTZType()),
        StructField("ingested_at", TimestampNTZType()),
        StructField("position_source", LongType()),
        StructField("squawk", StringType()),
        StructField("spi", BooleanType()),
        StructField("sensors", StringType()),
        StructField("source_file_path", StringType()),
        StructField("snapshot_date", DateType()),
        StructField("snapshot_hour", IntegerType()),
    ]
)

# Rejected states as written: Silver's columns, the place in the document and the first rule broken.
REJECT_SCHEMA = StructType(
    [*SILVER_SCHEMA.fields, StructField("state_ordinal", LongType()), StructField("reject_reason", StringType())]
)

GOLD_POSITION_SCHEMA = StructType(
    [f for f in SILVER_SCHEMA.fields if f.name in GOLD_POSITION_COLUMNS]
)

GOLD_METRIC_SCHEMA = StructType(
    [
        StructField("snapshot_timestamp", TimestampNTZType()),
        StructField("snapshot_date", DateType()),
        StructField("snapshot_hour", IntegerType()),
        StructField("country_of_origin", StringType()),
        StructField("total_flights", LongType()),
        StructField("airborne_flights", LongType()),
        StructField("grounded_flights", LongType()),
        StructField("avg_velocity", DoubleType()),
        StructField("avg_barometric_altitude_m", DoubleType()),
        StructField("max_geometric_altitude_m", DoubleType()),
    ]
)


def quoted(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return '"' + name.replace('"', '""') + '"'


def quoted_table(name: str) -> str:
    """A table name, ``schema.table`` too, as quoted SQL identifiers."""
    return ".".join(map(quoted, name.split(".")))


@dataclass(frozen=True)
class TableContract:
    """Columns, conflict keys and column rules of one published table."""

    name: str
    columns: list[str]
    keys: list[str]
    not_null: list[str] = field(default_factory=list)
    max_len: dict[str, int] = field(default_factory=dict)
    schema: StructType | None = None

    @property
    def update_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]

    def ddl(self, name: str | None = None, *, constraints: bool = True) -> str:
        """Generic ``CREATE TABLE`` text for a relational serving target.

        ``name`` is another table with these columns; without ``constraints`` it takes any rows.
        """
        sql_types = {
            "string": "VARCHAR",
            "double": "DOUBLE PRECISION",
            "boolean": "BOOLEAN",
            "bigint": "BIGINT",
            "int": "INTEGER",
            "date": "DATE",
            "timestamp_ntz": "TIMESTAMP",
        }
        if self.schema is None:
            raise ValueError(f"contract {self.name} has no schema")
        lines = []
        for f in self.schema.fields:
            t = sql_types[f.dataType.simpleString()]
            if f.name in self.max_len:
                t = f"VARCHAR({self.max_len[f.name]})"
            if constraints and f.name in self.not_null:
                t += " NOT NULL"
            lines.append(f"{quoted(f.name)} {t}")
        if constraints:
            lines.append(f"PRIMARY KEY ({', '.join(map(quoted, self.keys))})")
        body = ",\n    ".join(lines)
        return f"CREATE TABLE IF NOT EXISTS {quoted_table(name or self.name)} (\n    {body}\n)"


GOLD_POSITIONS = TableContract(
    name="gold_flight_positions",
    columns=GOLD_POSITION_COLUMNS,
    keys=POSITION_KEYS,
    not_null=POSITION_NOT_NULL,
    max_len=POSITION_MAX_LEN,
    schema=GOLD_POSITION_SCHEMA,
)

GOLD_METRICS = TableContract(
    name="gold_country_metrics",
    columns=GOLD_METRIC_COLUMNS,
    keys=METRIC_KEYS,
    not_null=METRIC_NOT_NULL,
    max_len=METRIC_MAX_LEN,
    schema=GOLD_METRIC_SCHEMA,
)

SERVING_CONTRACTS: dict[str, TableContract] = {
    GOLD_POSITIONS.name: GOLD_POSITIONS,
    GOLD_METRICS.name: GOLD_METRICS,
}
