import json

import pytest

from aerolake.contracts import RAW_SCHEMA
from aerolake.sources.bronze import decode_documents
from fixtures import HOUR, INGEST, doc, documents, state


def decode(spark, texts, **kw):
    return decode_documents(documents(spark, texts), **kw)


def test_clean_row_is_typed(spark):
    rows = decode(spark, [doc([state(sensors=[1, 2])])]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.icao24 == " abc123 " and r.callsign == "TAM3054 "
    assert r.time_position_unix == HOUR and r.last_contact_unix == HOUR + 5
    assert r.latitude == -5.8 and r.on_ground is False and r.squawk == "7700"
    assert r.sensors == "[1,2]"
    assert r.api_snapshot_time_unix == HOUR + 60 and r.record_timestamp_unix == INGEST
    assert r.source_file_path == "snap_test" and r.state_ordinal == 0


def test_schema_matches_contract(spark):
    df = decode(spark, [doc([state()])]).drop("state_ordinal")
    assert [(f.name, f.dataType) for f in df.schema.fields] == [
        (f.name, f.dataType) for f in RAW_SCHEMA.fields
    ]


def test_short_row_padded_long_row_truncated(spark):
    short = ["def456", None, None, HOUR + 1]
    long = state() + ["extra", 99]
    rows = decode(spark, [doc([short, long])]).orderBy("state_ordinal").collect()
    assert rows[0].icao24 == "def456" and rows[0].time_position_unix == HOUR + 1
    assert rows[0].last_contact_unix is None and rows[0].position_source is None
    assert rows[1].position_source == 0 and rows[1].icao24 == " abc123 "


def test_non_list_entries_skipped(spark):
    rows = decode(spark, [doc(["junk", {"k": 1}, None, state(code="x1"), []])]).collect()
    codes = sorted((r.icao24 or "<null>", r.state_ordinal) for r in rows)
    # the empty list decodes to an all-null row; neighbours keep their ordinals
    assert codes == [("<null>", 4), ("x1", 3)]


@pytest.mark.parametrize("text", ['{"time": 1, "states": null}', '{"time": 1}', '{"states": {"a": 1}}', "{not json"])
def test_states_null_missing_or_bad_gives_no_rows(spark, text):
    assert decode(spark, [text]).count() == 0


def test_numeric_coercion(spark):
    s1 = state(lat="12.3", lon=True, vel="abc", squawk=7700, sensors=None)
    r = decode(spark, [doc([s1])]).collect()[0]
    assert r.latitude == 12.3 and r.longitude == 1.0 and r.velocity is None
    assert r.squawk == "7700" and r.sensors is None


def test_strict_mode_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        decode(spark, [doc([state(vel="abc")])], strict=True).collect()


def test_missing_time_is_null(spark):
    r = decode(spark, [doc([state()], time=None)]).collect()[0]
    assert r.api_snapshot_time_unix is None


def test_state_offset_shifts_ordinal(spark):
    text = json.dumps({"time": 1, "states": [state(), state()], "state_offset": 10000})
    assert sorted(r.state_ordinal for r in decode(spark, [text]).collect()) == [10000, 10001]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_scalar = st.one_of(
    st.none(), st.booleans(), st.integers(-10**12, 10**12),
    st.floats(allow_nan=False, allow_infinity=False, width=32), st.text(max_size=6),
)
_value = st.one_of(_scalar, st.lists(_scalar, max_size=3))
_entry = st.one_of(st.lists(_value, max_size=20), _scalar, st.dictionaries(st.text(max_size=3), _scalar, max_size=2))


@settings(max_examples=15, deadline=None)
@given(st.lists(_entry, max_size=12))
def test_lenient_decode_never_fails_and_keeps_every_list(spark, states):
    rows = decode(spark, [json.dumps({"time": 1, "states": states})]).collect()
    lists = [i for i, s in enumerate(states) if isinstance(s, list)]
    assert sorted(r.state_ordinal for r in rows) == lists
