"""Zone-free time conversions.

Lake timestamps are ``TIMESTAMP_NTZ`` holding UTC wall-clock time, so results
never depend on the session time zone.  ``from_unixtime``/``unix_seconds`` and
casts between ``TIMESTAMP`` and ``TIMESTAMP_NTZ`` all go through the session
zone; the interval arithmetic below does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _epoch() -> Column:
    return F.expr(EPOCH_NTZ)

# File-name stamp of a landed snapshot: flight_snapshot_<yyyy-MM-dd_HH-mm-ss>.
SNAPSHOT_STAMP_REGEX = r"flight_snapshot_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})"
SNAPSHOT_STAMP_FORMAT = "yyyy-MM-dd_HH-mm-ss"


# Epoch seconds of the first and last second of the years 1 to 9999.
MIN_EPOCH, MAX_EPOCH = -62_135_596_800, 253_402_300_799


def epoch_to_ntz(seconds: Column | str) -> Column:
    """Epoch seconds -> UTC ``TIMESTAMP_NTZ`` (second precision, null-safe).

    Values outside the years 1 to 9999 (milliseconds taken for seconds, say) give NULL.
    """
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    valid = F.when(c.between(MIN_EPOCH, MAX_EPOCH), c)
    return _epoch() + F.make_dt_interval(secs=valid.cast("decimal(18,6)"))


def ntz_to_epoch(ts: Column | str) -> Column:
    """UTC ``TIMESTAMP_NTZ`` -> whole epoch seconds (fraction truncated)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (c - _epoch()).cast("interval second").cast("bigint")


def instant_from_path(path: Column | str, zone: str = "UTC") -> Column:
    """Run instant encoded in a Bronze path, converted from ``zone`` to UTC NTZ.

    Works for a file named ``flight_snapshot_<stamp>.json`` as well as for a
    directory ``snapshot=flight_snapshot_<stamp>`` written by our lander.
    """
    c = F.col(path) if isinstance(path, str) else path
    stamp = F.regexp_extract(c, SNAPSHOT_STAMP_REGEX, 1)
    local = F.to_timestamp_ntz(F.when(stamp != "", stamp), F.lit(SNAPSHOT_STAMP_FORMAT))
    if zone == "UTC":
        return local
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
