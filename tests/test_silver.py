import datetime as dt

from aerolake.operators.silver import (
    dedup_positions,
    rejected_positions,
    typed_positions,
    valid_positions,
)
from aerolake.plans.pipeline import bronze_to_silver
from aerolake.sources.bronze import decode_documents
from fixtures import HOUR, INGEST, doc, documents, state, utc


def typed(spark, texts, **kw):
    return typed_positions(decode_documents(documents(spark, texts, **kw)))


def test_trim_rename_and_ntz_timestamps(spark):
    r = typed(spark, [doc([state(code="\tab  ", call="  TAM3054 ")])]).collect()[0]
    # trim strips spaces only
    assert r.aircraft_code == "\tab" and r.flight_callsign == "TAM3054"
    assert r.position_timestamp == utc(HOUR)
    assert r.ingested_at == utc(INGEST)
    assert r.barometric_altitude_m == 1000.0 and r.geometric_altitude_m == 1100.0
    assert r.is_on_ground is False


def test_partition_is_utc_ingest_hour_whatever_the_session_zone(spark):
    ingest = 1716084607  # 2024-05-19 02:10:07 UTC
    r = typed(spark, [doc([state()])], ingest=ingest).collect()[0]
    assert r.snapshot_date == dt.date(2024, 5, 19) and r.snapshot_hour == 2
    assert spark.conf.get("spark.sql.session.timeZone") != "UTC"


def test_validity_rules_and_rejects(spark):
    states = [
        state(code="ok1"),
        state(code=None),
        state(code="   "),
        state(code="t", tpos=None),
        state(code="lat90", lat=90.0, lon=-180.0),
        state(code="latn", lat=None, lon=None),
        state(code="lat9001", lat=90.01),
        state(code="lonm", lon=-180.01),
    ]
    t = typed(spark, [doc(states)])
    kept = sorted(r.aircraft_code for r in valid_positions(t).collect())
    assert kept == ["lat90", "latn", "ok1"]
    reasons = sorted(
        ("<null>" if r.aircraft_code is None else r.aircraft_code, r.reject_reason) for r in rejected_positions(t).collect()
    )
    assert reasons == [
        ("", "blank_aircraft_code"),
        ("<null>", "null_aircraft_code"),
        ("lat9001", "latitude_out_of_range"),
        ("lonm", "longitude_out_of_range"),
        ("t", "null_position_timestamp"),
    ]
    assert valid_positions(t).count() + rejected_positions(t).count() == t.count()


def test_dedup_keeps_newest_contact(spark):
    s = [state(code="a", contact=HOUR + 10, vel=1.0), state(code="a", contact=HOUR + 20, vel=2.0)]
    rows = dedup_positions(valid_positions(typed(spark, [doc(s)]))).collect()
    assert [r.velocity for r in rows] == [2.0]


def test_dedup_equal_contacts_keeps_lowest_ordinal(spark):
    s = [state(code="a", vel=float(i)) for i in range(5)]
    rows = dedup_positions(valid_positions(typed(spark, [doc(s)]))).collect()
    assert [r.velocity for r in rows] == [0.0]


def test_dedup_null_contact_loses(spark):
    s = [state(code="a", contact=None, vel=1.0), state(code="a", contact=HOUR, vel=2.0)]
    rows = dedup_positions(valid_positions(typed(spark, [doc(s)]))).collect()
    assert [r.velocity for r in rows] == [2.0]


def test_dedup_scope_is_the_run(spark):
    a = documents(spark, [doc([state(code="a")])], ingest=INGEST)
    b = documents(spark, [doc([state(code="a")])], ingest=INGEST + 3600)
    silver = bronze_to_silver(a.unionByName(b))
    assert silver.count() == 2


def test_silver_keys_unique_per_run(spark):
    s = [state(code=c, tpos=HOUR + (i % 3)) for i, c in enumerate("abcabcabcaa")]
    silver = bronze_to_silver(documents(spark, [doc(s)]))
    assert silver.count() == silver.select("ingested_at", "aircraft_code", "position_timestamp").distinct().count()
    assert len(silver.columns) == 22


def test_hot_key_third_of_rows(spark):
    # one key holds a third of all states, spread over many partitions
    hot = [state(code="hot", contact=HOUR + (i % 50), vel=float(i)) for i in range(600)]
    cold = [state(code=f"c{i}", vel=1.0) for i in range(1200)]
    docs = documents(spark, [doc(hot[i::6] + cold[i::6], state_offset=i * 10000) for i in range(6)])
    silver = bronze_to_silver(docs.repartition(12))
    assert silver.count() == 1201
    r = silver.where("aircraft_code = 'hot'").collect()
    # newest contact is HOUR+49 (i % 50 == 49); lowest ordinal among those is i = 49 (doc 1, pos 8)
    assert len(r) == 1 and r[0].velocity == 49.0


def test_documents_of_one_run_keep_their_rows(spark):
    from aerolake.plans.pipeline import bronze_to_silver

    one, two = (documents(spark, [doc([state(code="a")])], source=s) for s in ("f1.json", "f2.json"))
    assert bronze_to_silver(one.unionByName(two)).count() == 2
    # parts of one landed snapshot are one document
    parts = [documents(spark, [doc([state(code="a", vel=v)])], source=f"/x/snapshot=s/{v}.json") for v in (1.0, 2.0)]
    kept = bronze_to_silver(parts[1].unionByName(parts[0])).collect()
    assert [r.velocity for r in kept] == [1.0]
