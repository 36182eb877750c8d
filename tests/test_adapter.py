import datetime as dt

from pyspark.sql import functions as F

from aerolake.plans.pipeline import bronze_to_silver
from aerolake.sources.bronze import decode_documents
from aerolake.sources.events_adapter import snapshot_documents

EV = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark, rows):
    return spark.createDataFrame(rows, EV)


def test_hour_is_zone_free_in_a_dst_gap(spark):
    ts = dt.datetime(2024, 3, 10, 2, 30, 7)  # a wall time New York skips
    docs = snapshot_documents(events(spark, [(1, ts, 8, "click", 1.0, "")])).collect()
    hour = int(dt.datetime(2024, 3, 10, 2, tzinfo=dt.UTC).timestamp())
    assert docs[0].source_file_path == f"snap_{hour}"
    assert docs[0].record_timestamp_unix == hour + 7200


def test_parts_keep_event_order(spark):
    base = dt.datetime(2024, 1, 1, 5, 0, 0)
    rows = [(i, base + dt.timedelta(seconds=i), 1, "click", float(i), "") for i in range(1, 10)]
    docs = snapshot_documents(events(spark, rows), part_size=4)
    assert docs.count() == 3  # ids 1-3, 4-7, 8-9
    raw = decode_documents(docs).where(F.col("icao24").isNotNull())
    ordered = [r.last_contact_unix for r in raw.orderBy("state_ordinal").collect()]
    assert ordered == sorted(ordered)


def test_equal_contacts_resolved_by_event_order_across_parts(spark):
    t = dt.datetime(2024, 1, 1, 5, 0, 0)
    # same user, same second: ids 102 and 105 land in different parts; 102 must win
    rows = [(105, t, 3, "click", 2.0, ""), (102, t, 3, "click", 1.0, "")]
    silver = bronze_to_silver(snapshot_documents(events(spark, rows), part_size=4))
    assert [r.velocity for r in silver.collect()] == [1.0]


def test_ltz_input_gives_the_same_documents(spark):
    base = dt.datetime(2024, 3, 10, 2, 30, 7)
    rows = [(i, base + dt.timedelta(minutes=7 * i), 1, "click", 1.0, "") for i in range(100, 130)]
    ntz = events(spark, rows)
    # the same wall-clock values held as TIMESTAMP (instants in UTC)
    from aerolake.functions.time import ntz_to_epoch

    ltz = ntz.withColumn("ts", F.timestamp_seconds(ntz_to_epoch("ts")))
    assert dict(ltz.dtypes)["ts"] == "timestamp"
    a = decode_documents(snapshot_documents(ntz)).collect()
    b = decode_documents(snapshot_documents(ltz)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 30
