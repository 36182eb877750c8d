"""Turn the ``events`` table into snapshot documents (test and bench input).

One snapshot per hour of ``ts``.  Every state vector is built as a VARIANT
array with built-in expressions; vectors are grouped into documents of at most
``part_size`` states (a busy hour becomes several parts of one snapshot, so no
group is unbounded), in ``event_id`` order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from aerolake.functions.time import ntz_to_epoch

PART_SIZE = 10_000


def _v(c: Column) -> Column:
    return c.cast("variant")


def _null() -> Column:
    return F.lit(None).cast("variant")


def _epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole epoch seconds of a timestamp column of either timestamp type.

    ``events.ts`` is read as TIMESTAMP_NTZ (UTC wall clock); a session that
    reads it as TIMESTAMP instead gets the same instant through ``unix_micros``.
    Both forms are independent of the session zone.
    """
    if isinstance(df.schema[name].dataType, TimestampType):
        return F.floor(F.unix_micros(F.col(name)) / F.lit(1_000_000)).cast("bigint")
    return ntz_to_epoch(F.col(name))


def state_vectors(events: DataFrame) -> DataFrame:
    """One VARIANT state vector per event plus its hour (``hu``) and id."""
    # hour start by integer arithmetic on epoch seconds: date_trunc on a
    # TIMESTAMP_NTZ would go through the session zone (wrong across DST)
    base = events.select(
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        F.col("event_type").alias("et"),
        F.col("value").alias("val"),
        _epoch_seconds(events, "ts").alias("su"),
    ).withColumn("hu", F.col("su") - F.pmod(F.col("su"), F.lit(3600)))
    e, u, et, val, hu, su = (F.col(c) for c in ("e", "u", "et", "val", "hu", "su"))
    code = (
        F.when(e % 41 == 0, F.lit(None).cast("string"))
        .when(e % 43 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.lower(F.hex(u)), F.lit(" ")))
    )
    country = F.when(u % 25 == 7, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("NATION_"), (u % 25).cast("string"), F.lit(" "))
    )
    position_time = F.when(e % 47 == 0, F.lit(None).cast("bigint")).when(
        e % 13 == 0, hu - 3600
    ).otherwise(hu)
    on_ground = (
        F.when(et.isin("view", "signup"), F.lit(True))
        .when(et == "error", F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )
    sensors = F.when(e % 5 == 0, _v(F.array(e % 7, F.lit(9).cast("bigint")))).otherwise(_null())
    full = F.array(
        _v(code),
        _v(F.concat(F.upper(et), F.lit("  "))),
        _v(country),
        _v(position_time),
        _v(su),
        _v(F.when(e % 53 == 0, F.lit(None).cast("double")).otherwise(e % 400 - 200 + F.lit(0.5))),
        _v(e % 200 - 100 + F.lit(0.25)),
        _v(F.when(e % 59 == 0, F.lit(None).cast("double")).otherwise(val)),
        _v(on_ground),
        _v(val),
        _v(e % 360),
        _null(),
        sensors,
        _v(u * F.lit(1.5)),
        _v(F.lpad((e % 7777).cast("string"), 4, "0")),
        _v(F.lit(False)),
        _v(e % 4),
    )
    short = F.array(
        _v(F.concat(F.lit("short"), e.cast("string"))), _null(), _null(), _v(hu), _v(su)
    )
    state = (
        F.when(e % 67 == 0, _v(F.lit("junk")))
        .when(e % 61 == 0, _v(short))
        .otherwise(_v(full))
    )
    return base.select("e", "hu", state.alias("state"))


def snapshot_documents(events: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """``events`` -> document frame (see ``aerolake.sources.bronze``)."""
    vectors = state_vectors(events).withColumn(
        "part", F.floor(F.col("e") / F.lit(part_size)).cast("bigint")
    )
    parts = vectors.groupBy("hu", "part").agg(
        F.collect_list(F.struct("e", "state")).alias("items")
    )
    ordered = F.expr(
        "transform(array_sort(items, (l, r) -> "
        "CASE WHEN l.e < r.e THEN -1 WHEN l.e > r.e THEN 1 ELSE 0 END), x -> x.state)"
    )
    hu = F.col("hu")
    return parts.select(
        F.when((hu / 3600).cast("bigint") % 11 == 0, F.lit(None).cast("bigint"))
        .otherwise(hu + 3600)
        .alias("time"),
        ordered.cast("variant").alias("states"),
        # ordinal base of the part: states of one hour keep event_id order
        F.when(F.col("part") > 0, F.col("part") * part_size).alias("state_offset"),
        F.concat(F.lit("snap_"), hu.cast("string")).alias("source_file_path"),
        (hu + 7200).alias("record_timestamp_unix"),
    )
