"""Serving upsert: contract, column mismatch, pruning, and publishes that died."""

import duckdb
import pytest
from pyspark.sql import functions as F

from aerolake.contracts import GOLD_POSITIONS
from aerolake.operators.quality import ContractError
from aerolake.plans.oracle import oracle_queries
from aerolake.plans.pipeline import bronze_to_silver
from aerolake.plans.register import queries
from aerolake.sinks import serving as S
from aerolake.operators.gold import latest_positions
from aerolake.storage import create_new, names
from fixtures import HOUR, doc, documents, state
from oracle_compare import compare
from plan_utils import plan_text


def silver(spark, *codes, **kw):
    return bronze_to_silver(documents(spark, [doc([state(code=c, **kw) for c in codes])]))


def codes(spark, path):
    return sorted(r.aircraft_code for r in S.read_serving(spark, path, GOLD_POSITIONS).collect())


def test_contract_is_enforced_before_any_write(spark, scratch):
    path = scratch("serving")
    S.upsert_serving(spark, path, silver(spark, "a"), GOLD_POSITIONS)
    with pytest.raises(ContractError, match="max_len:aircraft_code"):
        S.upsert_serving(spark, path, silver(spark, "b", "x" * 40), GOLD_POSITIONS)
    missing = silver(spark, "c").withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(ContractError, match="not_null:ingested_at"):
        S.upsert_serving(spark, path, missing, GOLD_POSITIONS)
    assert codes(spark, path) == ["a"]


def test_table_without_a_contract_column_is_left_alone(spark, scratch):
    path = scratch("serving")
    rows = silver(spark, "a", "b").select(*GOLD_POSITIONS.columns).drop("velocity")
    rows.withColumn("key_date", F.to_date("position_timestamp")).write.partitionBy("key_date").parquet(path)
    with pytest.raises(Exception, match="velocity"):
        S.upsert_serving(spark, path, silver(spark, "z"), GOLD_POSITIONS)
    assert sorted(r.aircraft_code for r in spark.read.parquet(path).collect()) == ["a", "b"]


def hourly(spark, *hours, code="a", vel=1.0):
    """One position an hour of May 2024, each in a run of its own hour."""
    return bronze_to_silver(documents(spark, [doc([state(code=code, tpos=HOUR + 3600 * h, vel=vel) for h in hours])]))


def live(spark, path):
    return {(str(p.key_date), p.key_slot, p.key_part): p for p in S.current(spark, path).manifest(spark).collect()}


@pytest.mark.parametrize("step", ["write_partitioned", "_write_version", "commit", "create_new", "vacuum"])
def test_a_publish_that_dies_leaves_the_table_before_or_after_it(spark, scratch, monkeypatch, step):
    path = scratch("serving")
    S.upsert_serving(spark, path, hourly(spark, 0, 1, 30), GOLD_POSITIONS)
    before = sorted(map(tuple, S.read_serving(spark, path, GOLD_POSITIONS).collect()))
    real = getattr(S, step)

    def dying(*args, **kw):
        if step in ("write_partitioned", "_write_version"):
            real(*args, **kw)
        raise OSError("lost")

    monkeypatch.setattr(S, step, dying)
    with pytest.raises(OSError):
        S.upsert_serving(spark, path, hourly(spark, 1, 2, vel=2.0), GOLD_POSITIONS)
    monkeypatch.undo()
    rows = S.read_serving(spark, path, GOLD_POSITIONS).collect()
    if step == "vacuum":  # the publish was committed
        assert len(rows) == 4 and sum(r.velocity == 2.0 for r in rows) == 2
    else:
        assert sorted(map(tuple, rows)) == before
    # the next publish goes on from there and removes what the dead one left
    S.upsert_serving(spark, path, hourly(spark, 1, 2, vel=2.0), GOLD_POSITIONS)
    rows = S.read_serving(spark, path, GOLD_POSITIONS).collect()
    assert len(rows) == 4 and sum(r.velocity == 2.0 for r in rows) == 2
    used = {s.manifest_id for s in S.snapshots(spark, path)}
    assert {n.split("=")[1] for n in names(spark, f"{path}/data")} <= used == set(names(spark, f"{path}/manifests"))


def test_a_log_entry_that_was_not_finished_is_not_a_version(spark, scratch):
    path = scratch("serving")
    S.upsert_serving(spark, path, hourly(spark, 0), GOLD_POSITIONS)
    create_new(spark, f"{path}/log/0000000001", '{"manifest": "x')
    assert S.read_serving(spark, path, GOLD_POSITIONS).count() == 1
    S.upsert_serving(spark, path, hourly(spark, 1), GOLD_POSITIONS)
    assert S.read_serving(spark, path, GOLD_POSITIONS).count() == 2


def test_a_publish_reads_and_writes_only_the_hours_of_its_batch(spark, scratch, monkeypatch):
    path = scratch("serving")
    S.upsert_serving(spark, path, hourly(spark, *range(0, 30 * 24, 6)), GOLD_POSITIONS)
    before = live(spark, path)
    assert len({d for d, _, _ in before}) >= 30
    read = []
    real = S._read
    monkeypatch.setattr(S, "_read", lambda *a: read.append(real(*a)) or read[-1])
    S.upsert_serving(spark, path, hourly(spark, 12, vel=2.0), GOLD_POSITIONS)
    (affected,) = read
    assert len(affected.inputFiles()) == 1 and plan_text(affected).count("key_date=") <= 2
    after = live(spark, path)
    assert before.keys() == after.keys()
    assert sum(after[k].version != before[k].version for k in after) == 1


def test_hash_parts_of_an_hour(spark, scratch):
    path, plain = scratch("serving"), scratch("serving")
    first = bronze_to_silver(documents(spark, [doc([state(code=f"c{i}") for i in range(40)])]))
    second = bronze_to_silver(documents(spark, [doc([state(code=f"c{i}", vel=5.0) for i in (3, 41)])]))
    for target, layout in ((path, {"parts": 4}), (plain, {})):
        assert S.upsert_serving(spark, target, first, GOLD_POSITIONS, **layout) == {"inserted_count": 40, "updated_count": 0}
    before = live(spark, path)
    assert {part for _, _, part in before} == {0, 1, 2, 3}
    for target in (path, plain):
        assert S.upsert_serving(spark, target, second, GOLD_POSITIONS) == {"inserted_count": 1, "updated_count": 1}
    assert sum(p.version != before[k].version for k, p in live(spark, path).items()) <= 2
    columns = GOLD_POSITIONS.columns
    got, want = (S.read_serving(spark, t, GOLD_POSITIONS).select(*columns) for t in (path, plain))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_earlier_versions_stay_readable_and_old_ones_go(spark, scratch):
    path = scratch("serving")
    S.upsert_serving(spark, path, hourly(spark, 0, 1), GOLD_POSITIONS)
    reading = S.read_serving(spark, path, GOLD_POSITIONS)
    for v in range(1, S.KEEP):
        S.upsert_serving(spark, path, hourly(spark, 0, vel=float(v)), GOLD_POSITIONS)
    assert sorted(r.velocity for r in reading.collect()) == [1.0, 1.0]
    for v in range(5):
        S.upsert_serving(spark, path, hourly(spark, 0, vel=float(v)), GOLD_POSITIONS)
    assert len(S.snapshots(spark, path)) == S.KEEP == len(names(spark, f"{path}/manifests"))
    # the first version holds hour 1 alone by now, and the kept ones one hour each
    held = [f for n in names(spark, f"{path}/data") for f in spark.read.parquet(f"{path}/data/{n}").inputFiles()]
    assert len(held) == S.KEEP + 1


def test_newest_rows_and_counts_come_from_the_manifest(spark, scratch):
    path = scratch("serving")
    for h in range(6):
        run = documents(spark, [doc([state(code=f"{h}{i}", tpos=HOUR + 3600 * h) for i in range(10)])], ingest=HOUR + 3600 * h)
        S.upsert_serving(spark, path, bronze_to_silver(run), GOLD_POSITIONS)
    newest = S.newest_serving(spark, path, GOLD_POSITIONS, 20)
    assert len(newest.inputFiles()) == 2
    whole = latest_positions(S.read_serving(spark, path, GOLD_POSITIONS))
    assert latest_positions(newest).collect() == whole.collect()
    counts = S.serving_counts(spark, {"t": path, "none": scratch("nothing")})
    assert not [f for f in counts.inputFiles() if "/data/" in f]
    assert {r.table_name: r.row_count for r in counts.collect()} == {"t": 60, "none": 0}


def test_a_table_of_the_former_layout_is_moved_by_the_next_publish(spark, scratch):
    path = scratch("serving")
    rows = silver(spark, "a", "b").select(*GOLD_POSITIONS.columns)
    rows.withColumn("key_date", F.to_date("position_timestamp")).write.partitionBy("key_date").parquet(path)
    assert codes(spark, path) == ["a", "b"]
    assert S.upsert_serving(spark, path, silver(spark, "b", "c"), GOLD_POSITIONS) == {"inserted_count": 1, "updated_count": 1}
    assert codes(spark, path) == ["a", "b", "c"]
    assert sorted(names(spark, path)) == ["data", "log", "manifests"]


def test_two_writers_at_once(spark, scratch):
    path = scratch("serving")
    S.upsert_serving(spark, path, hourly(spark, 0), GOLD_POSITIONS)
    seen = S.current(spark, path)
    S.upsert_serving(spark, path, hourly(spark, 1), GOLD_POSITIONS)
    with pytest.raises(RuntimeError, match="another writer"):
        S.commit(spark, path, seen.manifest(spark), "late", seen, 24, 1)


def test_empty_batch(spark, scratch):
    path = scratch("serving")
    assert S.upsert_serving(spark, path, silver(spark), GOLD_POSITIONS) == {"inserted_count": 0, "updated_count": 0}
    S.upsert_serving(spark, path, silver(spark, "a"), GOLD_POSITIONS)
    assert S.upsert_serving(spark, path, silver(spark), GOLD_POSITIONS) == {"inserted_count": 0, "updated_count": 0}
    assert codes(spark, path) == ["a"]


@pytest.mark.parametrize("name", ["serving_upsert_positions", "serving_latest_positions", "serving_manifest_counts"])
def test_positions_made_of_events_of_large_ids_are_published(spark, tmp_path, name):
    # every 61st event has a code of "short" and its id, which has 6 digits and more in larger tables
    ids = [61 * i for i in (1, 2, 3, 2000, 2001, 10**15, 10**15 + 1)] + [9_000_000_000_000_000_001]
    rows = [(e, f"2024-01-{10 + i % 9:02d} 0{i % 3}:10:00", e % 1000 + 2**50 * (i % 2), "click", 1.5) for i, e in enumerate(ids)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    ok, msg = compare(queries()[name](spark, str(tmp_path)), con, oracle_queries()[name])
    assert ok, msg
