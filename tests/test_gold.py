from aerolake.operators.gold import (
    busiest_countries,
    country_metrics,
    gold_positions,
    latest_positions,
    row_counts,
)
from aerolake.plans.pipeline import bronze_to_silver
from fixtures import HOUR, INGEST, doc, documents, state, utc


def silver(spark, states, **kw):
    return bronze_to_silver(documents(spark, [doc(states, **kw)]))


def test_detail_projection(spark):
    g = gold_positions(silver(spark, [state()]))
    assert len(g.columns) == 17
    assert not {"squawk", "spi", "sensors", "position_source", "source_file_path"} & set(g.columns)


def test_country_groups_and_ground_counts(spark):
    states = [
        state(code="a", country=None, ground=True),
        state(code="b", country="UNKNOWN", ground=None),
        state(code="c", country="", ground=False),
        state(code="d", country=" BR ", ground=False, vel=100.0, baro=None),
        state(code="e", country="BR", ground=None, vel=None, baro=None, geo=None),
    ]
    m = {r.country_of_origin: r for r in country_metrics(silver(spark, states)).collect()}
    assert set(m) == {"UNKNOWN", "", "BR"}
    assert (m["UNKNOWN"].total_flights, m["UNKNOWN"].airborne_flights, m["UNKNOWN"].grounded_flights) == (2, 0, 1)
    br = m["BR"]
    assert (br.total_flights, br.airborne_flights, br.grounded_flights) == (2, 1, 0)
    assert br.avg_velocity == 100.0 and br.avg_barometric_altitude_m is None
    assert br.max_geometric_altitude_m == 1100.0


def test_missing_feed_time_falls_back_to_ingest(spark):
    s = silver(spark, [state()], time=None)
    assert gold_positions(s).collect()[0].snapshot_timestamp is None
    r = country_metrics(s).collect()[0]
    assert r.snapshot_timestamp == utc(INGEST)


def test_metrics_schema(spark):
    from aerolake.contracts import GOLD_METRIC_SCHEMA

    m = country_metrics(silver(spark, [state()]))
    assert [(f.name, f.dataType) for f in m.schema.fields] == [
        (f.name, f.dataType) for f in GOLD_METRIC_SCHEMA.fields
    ]


def test_topk_and_counts(spark):
    states = [state(code=f"c{i}", tpos=HOUR - i) for i in range(30)]
    s = silver(spark, states)
    top = latest_positions(gold_positions(s), 20).collect()
    assert len(top) == 20 and top[0].aircraft_code == "c0"
    assert len(busiest_countries(country_metrics(s), 20).collect()) == 1
    counts = {r.table_name: r.row_count for r in row_counts({"a": s, "b": country_metrics(s)}).collect()}
    assert counts == {"a": 30, "b": 1}


def test_two_runs_of_an_hour_share_a_group(spark):
    docs = documents(spark, [doc([state(code="a")])]).unionByName(documents(spark, [doc([state(code="b")])], ingest=INGEST + 60))
    s = bronze_to_silver(docs)
    assert [r.total_flights for r in country_metrics(s).collect()] == [2]
    assert [r.total_flights for r in country_metrics(s, keep_run=True).collect()] == [1, 1]
