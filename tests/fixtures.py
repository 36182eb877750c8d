"""Hand-made snapshot documents (FIXTURES §2)."""

from __future__ import annotations

import datetime as dt
import json

from aerolake.sources.bronze import parse_documents

HOUR = 1716000000 - 1716000000 % 3600  # an hour boundary in May 2024
INGEST = HOUR + 5 * 60  # the run instant


def state(code=" abc123 ", call="TAM3054 ", country="Brazil", tpos=HOUR, contact=HOUR + 5,
          lon=-35.2, lat=-5.8, baro=1000.0, ground=False, vel=200.0, head=90.0, vrate=0.0,
          sensors=None, geo=1100.0, squawk="7700", spi=False, source=0):
    return [code, call, country, tpos, contact, lon, lat, baro, ground, vel, head, vrate,
            sensors, geo, squawk, spi, source]


def doc(states, time=HOUR + 60, **extra):
    d = {"states": states}
    if time is not None:
        d["time"] = time
    d.update(extra)
    return json.dumps(d)


def documents(spark, texts, ingest=INGEST, source="snap_test"):
    rows = [(t, source, ingest) for t in texts]
    df = spark.createDataFrame(rows, "value string, source_file_path string, record_timestamp_unix bigint")
    return parse_documents(df)


def utc(epoch: int) -> dt.datetime:
    """Naive UTC wall-clock time of an epoch second (what TIMESTAMP_NTZ holds)."""
    return dt.datetime.fromtimestamp(epoch, dt.UTC).replace(tzinfo=None)
