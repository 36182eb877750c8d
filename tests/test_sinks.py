import json
import os

from pyspark.sql import functions as F

from aerolake.contracts import GOLD_METRIC_COLUMNS, SILVER_COLUMNS
from aerolake.operators.gold import country_metrics
from aerolake.plans import register as R
from aerolake.plans.pipeline import LakePaths, bronze_to_silver, replay_bronze, run_medallion
from aerolake.sinks.lake import land_bronze, read_lake_table, write_partitioned
from aerolake.sources.bronze import corrupt_documents, decode_documents, read_bronze
from conftest import SF_SMALL
from fixtures import HOUR, doc, documents, state, utc
from plan_utils import plan_text


def test_partition_roundtrip_append_and_replace(spark, scratch):
    silver = bronze_to_silver(documents(spark, [doc([state(code=c) for c in "abc"])]))
    p = scratch("silver")
    write_partitioned(silver, p)
    back = read_lake_table(spark, p, SILVER_COLUMNS)
    assert dict(back.dtypes)["snapshot_date"] == "date" and dict(back.dtypes)["snapshot_hour"] == "int"
    assert back.count() == 3
    write_partitioned(silver, p, mode="append")
    assert read_lake_table(spark, p).count() == 6
    write_partitioned(silver, p, mode="replace_partitions")
    assert read_lake_table(spark, p).count() == 3


def test_lake_read_prunes_partitions_and_columns(spark, scratch):
    silver = bronze_to_silver(documents(spark, [doc([state()])]))
    p = scratch("silver")
    write_partitioned(silver, p)
    q = country_metrics(read_lake_table(spark, p).where(F.col("snapshot_hour") == 4))
    text = plan_text(q)
    assert "PartitionFilters: [isnotnull(snapshot_hour" in text
    read_schema = [l for l in text.splitlines() if "ReadSchema" in l][0]
    assert "squawk" not in read_schema and "velocity" in read_schema


def test_land_bronze_layout_and_replay_instant(spark, scratch):
    root = scratch("bronze")
    docs = R.documents(spark, SF_SMALL)
    land_bronze(docs, root, zone="America/Recife")
    back = read_bronze(spark, root, multi_line=False, zone="America/Recife")
    # directory hour is local (UTC-3); the run instant read back is the original
    row = back.orderBy("record_timestamp_unix").select("hour", "record_timestamp_unix").first()
    assert (utc(row.record_timestamp_unix).hour - 3) % 24 == row.hour
    left = decode_documents(docs).drop("source_file_path").orderBy("record_timestamp_unix", "state_ordinal")
    right = decode_documents(back).drop("source_file_path").orderBy("record_timestamp_unix", "state_ordinal")
    assert left.collect() == right.collect()


def test_bronze_partition_filter_is_pushed(spark, scratch):
    root = scratch("bronze")
    land_bronze(R.documents(spark, SF_SMALL), root)
    q = read_bronze(spark, root, multi_line=False).where((F.col("day") == 2) & (F.col("hour") == 5))
    text = plan_text(q)
    assert "PartitionFilters" in text and "(day#" in text.split("PartitionFilters")[1].split("\n")[0]
    assert q.count() > 0


def test_truncated_file_is_isolated(spark, tmp_path):
    d = tmp_path / "hour=01"
    d.mkdir()
    (d / "flight_snapshot_2024-05-18_23-10-07.json").write_text(
        json.dumps({"time": HOUR, "states": [state(code="a"), state(code="b")]}, indent=4)
    )
    (d / "flight_snapshot_2024-05-18_23-20-07.json").write_text('{"time": 1, "states": [[')
    docs = read_bronze(spark, str(tmp_path), multi_line=True, zone="America/Recife")
    bad = corrupt_documents(docs).collect()
    assert len(bad) == 1 and bad[0].source_file_path.endswith("23-20-07.json")
    silver = bronze_to_silver(docs)
    rows = silver.collect()
    assert sorted(r.aircraft_code for r in rows) == ["a", "b"]
    # 23:10:07 on 18 May in Recife is 02:10:07 on 19 May UTC
    assert rows[0].ingested_at == utc(1716084607)
    assert (rows[0].snapshot_date.isoformat(), rows[0].snapshot_hour) == ("2024-05-19", 2)


def test_live_run_writes_all_layers(spark, scratch, tmp_path):
    f = tmp_path / "flight_snapshot_2024-05-19_02-00-00.json"
    f.write_text(json.dumps({"time": HOUR, "states": [state(code="a"), state(code="b", country=None)]}, indent=4))
    lake = LakePaths.under(scratch("lake"))
    pos, met = run_medallion(spark, str(f), lake, record_epoch=1716084000, multi_line=True)
    assert pos.count() == 2 and met.count() == 2
    pos, met = run_medallion(spark, str(f), lake, record_epoch=1716087600, multi_line=True)
    # append mode: a second run adds its own rows (the lake keeps history)
    assert pos.count() == 4 and met.count() == 4
    assert read_lake_table(spark, lake.silver).count() == 4


def test_replay_equals_in_memory_and_is_idempotent(spark, scratch):
    root = scratch("bronze")
    docs = R.documents(spark, SF_SMALL)
    land_bronze(docs, root, zone="America/Recife")
    lake = LakePaths.under(scratch("lake"))
    _, met = replay_bronze(spark, root, lake, zone="America/Recife", round_digits=6)
    expected = country_metrics(bronze_to_silver(docs), round_digits=6)
    key = GOLD_METRIC_COLUMNS
    assert sorted(met.select(*key).collect()) == sorted(expected.select(*key).collect())
    _, met2 = replay_bronze(spark, root, lake, zone="America/Recife", round_digits=6)
    assert met2.count() == expected.count()
    assert os.path.isdir(lake.silver.replace("file:", ""))


def test_landing_is_zone_free_in_a_dst_gap(spark, scratch):
    # 02:30 on 10 March 2024 does not exist in the session zone (New York)
    ingest = 1710037800  # 2024-03-10 02:30:00 UTC
    root = scratch("bronze")
    land_bronze(documents(spark, [doc([state()])], ingest=ingest), root)
    back = read_bronze(spark, root, multi_line=False)
    r = back.select("day", "hour", "record_timestamp_unix", "source_file_path").first()
    assert (r.day, r.hour, r.record_timestamp_unix) == (10, 2, ingest)
    assert "flight_snapshot_2024-03-10_02-30-00" in r.source_file_path


def test_bronze_partition_helper_prunes(spark, scratch):
    import datetime as dt

    from aerolake.sources.bronze import bronze_partition

    root = scratch("bronze")
    ingest = 1716084607  # 2024-05-19 02:10:07 UTC = 18 May 23:10:07 in Recife
    land_bronze(documents(spark, [doc([state()])], ingest=ingest), root, zone="America/Recife")
    land_bronze(documents(spark, [doc([state()])], ingest=ingest + 7200), root, zone="America/Recife")
    q = read_bronze(spark, root, multi_line=False, zone="America/Recife").where(
        bronze_partition(dt.datetime(2024, 5, 19, 2, 10, 7), "America/Recife")
    )
    assert "PartitionFilters: [isnotnull(year" in plan_text(q)
    rows = q.select("day", "hour", "record_timestamp_unix").collect()
    assert [(r.day, r.hour, r.record_timestamp_unix) for r in rows] == [(18, 23, ingest)]


def test_consumer_sql_over_serving_views(spark, scratch):
    from aerolake.contracts import GOLD_METRICS, GOLD_POSITIONS, SERVING_CONTRACTS
    from aerolake.sinks.serving import register_serving_views, upsert_serving

    silver = bronze_to_silver(documents(spark, [doc([state(code=c) for c in "abc"])]))
    paths = {"gold_flight_positions": scratch("sp"), "gold_country_metrics": scratch("sm")}
    upsert_serving(spark, paths["gold_flight_positions"], silver, GOLD_POSITIONS)
    upsert_serving(spark, paths["gold_country_metrics"], country_metrics(silver), GOLD_METRICS)
    assert register_serving_views(spark, paths, SERVING_CONTRACTS) == list(paths)
    top = spark.sql(
        "SELECT aircraft_code, ingested_at FROM gold_flight_positions "
        "ORDER BY ingested_at DESC, aircraft_code LIMIT 20"
    ).collect()
    assert [r.aircraft_code for r in top] == ["a", "b", "c"]
    counts = spark.sql(
        "SELECT 'gold_flight_positions' AS t, COUNT(*) AS n FROM gold_flight_positions "
        "UNION ALL SELECT 'gold_country_metrics', COUNT(*) FROM gold_country_metrics"
    ).collect()
    assert {r.t: r.n for r in counts} == {"gold_flight_positions": 3, "gold_country_metrics": 1}


def test_partition_hour_is_the_utc_ingest_hour_not_the_directory(spark, tmp_path):
    d = tmp_path / "year=2024" / "month=05" / "day=19" / "hour=02"
    d.mkdir(parents=True)
    (d / "snapshot.json").write_text(json.dumps({"time": HOUR, "states": [state()]}, indent=4))
    five_utc = 1716094800  # 2024-05-19 05:00:00 UTC
    docs = read_bronze(spark, str(tmp_path), multi_line=True, record_epoch=five_utc)
    r = bronze_to_silver(docs).select("snapshot_date", "snapshot_hour", "ingested_at").first()
    assert (r.snapshot_date.isoformat(), r.snapshot_hour) == ("2024-05-19", 5)
    assert r.ingested_at == utc(five_utc)
    assert docs.select("hour").first().hour == 2


def test_live_run_reads_back_only_its_partition(spark, scratch):
    from aerolake.plans.pipeline import written_silver

    lake = LakePaths.under(scratch("lake"))
    silver = bronze_to_silver(documents(spark, [doc([state()])], ingest=1716084000))
    write_partitioned(silver, lake.silver)
    text = plan_text(written_silver(spark, lake, 1716084000))
    assert "PartitionFilters: [isnotnull(snapshot_date" in text and "(snapshot_hour" in text
    assert "PushedFilters: [IsNotNull(ingested_at), EqualTo(ingested_at" in text
    assert written_silver(spark, lake, 1716084000).count() == 1
    assert written_silver(spark, lake, 1716087600).count() == 0


def test_live_run_again_replaces_its_rows(spark, scratch, tmp_path):
    f = tmp_path / "snapshot.json"
    lake = LakePaths.under(scratch("lake"))
    for codes in ("abc", "ab"):
        f.write_text(json.dumps({"time": HOUR, "states": [state(code=c) for c in codes]}, indent=4))
        pos, met = run_medallion(spark, str(f), lake, record_epoch=1716084000, multi_line=True)
    assert sorted(r.aircraft_code for r in pos.collect()) == ["a", "b"]
    assert [r.total_flights for r in met.collect()] == [2]
    # the snapshot turns out empty: nothing of the run stays
    f.write_text(json.dumps({"time": HOUR, "states": []}, indent=4))
    pos, met = run_medallion(spark, str(f), lake, record_epoch=1716084000, multi_line=True)
    assert pos.count() == met.count() == 0


def test_empty_snapshot_on_a_fresh_lake(spark, scratch, tmp_path):
    f = tmp_path / "flight_snapshot_2024-05-19_02-00-00.json"
    f.write_text(json.dumps({"time": HOUR, "states": []}))
    pos, met = run_medallion(spark, str(f), LakePaths.under(scratch("lake")), record_epoch=1716084000)
    assert (pos.count(), met.count()) == (0, 0)
    pos, met = replay_bronze(spark, str(tmp_path), LakePaths.under(scratch("lake")))
    assert (pos.count(), met.count()) == (0, 0)


def test_corrupt_documents_of_a_run_are_quarantined(spark, scratch, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"time": HOUR, "states": [state(code="a")]}, indent=4))
    (tmp_path / "b.json").write_text('{"time": 1, "states": [[')
    lake = LakePaths.under(scratch("lake"))
    pos, _ = run_medallion(spark, str(tmp_path), lake, record_epoch=1716084000, multi_line=True)
    assert pos.count() == 1
    assert [r.document for r in spark.read.parquet(lake.quarantine).collect()] == ['{"time": 1, "states": [[']


def test_gold_positions_are_written_as_read_without_a_shuffle(spark, scratch):
    from dataclasses import replace

    from aerolake.contracts import SILVER_COLUMNS, SILVER_SCHEMA
    from aerolake.plans.pipeline import LakePaths, bronze_to_silver, write_gold
    from aerolake.sinks.lake import read_runs, write_runs
    from fixtures import INGEST, doc, documents, state

    lake = replace(LakePaths.under(scratch("lake")), gold_metrics=None)
    runs = [INGEST, INGEST + 3600]
    for run in runs:
        write_runs(bronze_to_silver(documents(spark, [doc([state(code="a"), state(code="b")])], ingest=run)), lake.silver)
    silver = read_runs(spark, lake.silver, runs, SILVER_SCHEMA).select(*SILVER_COLUMNS)
    sc = spark.sparkContext
    sc.setJobGroup("gold", "positions")
    try:
        write_gold(silver, lake, processed=runs, filled=runs, tasks=4)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("gold")]
    assert sum(len(j.stageIds) for j in jobs) == 1
    back = read_lake_table(spark, lake.gold_positions)
    assert sorted((r.aircraft_code, r.run) for r in back.collect()) == [(c, r) for c in "ab" for r in runs]
