"""Bronze intake: formats, counts, rejects, and runs replaced also by nothing."""

import json

import pytest

from aerolake.__main__ import main
from aerolake.contracts import SILVER_COLUMNS
from aerolake.plans.intake import UnreadableBronze, bronze_files, take_in
from aerolake.plans.pipeline import LakePaths, bronze_to_silver, process_bronze, read_gold, read_rejects, read_runs_table
from aerolake.sinks.lake import land_bronze, land_texts, read_lake_table, run_directory
from aerolake.sources.bronze import read_bronze
from aerolake.storage import exists
from aerolake.streaming import incremental_silver
from fixtures import HOUR, INGEST, doc, documents, state

NAME = "flight_snapshot_2024-05-19_02-{:02d}-00.json"


def write(folder, minute, text):
    (folder / NAME.format(minute)).write_text(text)


def indented(*codes, **kw):
    return json.dumps(json.loads(doc([state(code=c, **kw) for c in codes])), indent=4)


def codes(spark, path):
    return sorted(r.aircraft_code for r in read_lake_table(spark, path, SILVER_COLUMNS).collect())


def test_indented_and_line_files_by_default(spark, scratch, tmp_path):
    write(tmp_path, 0, indented("a", "b"))
    write(tmp_path, 1, doc([state(code="c")]) + "\n" + doc([state(code="d")]))
    write(tmp_path, 2, doc([state(code="e")]) + "\n" + '{"time": 1, "states": [["f"')
    write(tmp_path, 3, indented("g")[:80])
    write(tmp_path, 4, "")
    write(tmp_path, 5, json.dumps({"states": [{}, [], {"a": 1}, state(code="h")], "time": HOUR}, indent=1))
    lake = LakePaths.under(scratch("lake"))
    counts = process_bronze(spark, str(tmp_path), lake)
    assert codes(spark, lake.silver) == ["a", "b", "c", "d", "e", "h"]
    assert (counts["files"], counts["documents"], counts["quarantined"], counts["kept"]) == (5, 5, 2, 6)
    bad = {r.source_file_path[-10:-5]: r.document for r in spark.read.parquet(lake.quarantine).collect()}
    assert bad == {"02-00": '{"time": 1, "states": [["f"', "03-00": indented("g")[:80]}
    runs = {r.run % 3600 // 60: (r.files, r.kept, r.quarantined) for r in read_runs_table(spark, lake.runs).collect()}
    assert runs == {0: (1, 2, 0), 1: (1, 2, 0), 2: (1, 1, 1), 3: (1, 0, 1), 5: (1, 1, 0)}


def test_lines_alone_are_read_once(spark, scratch, tmp_path, monkeypatch):
    from aerolake.plans import intake as I

    write(tmp_path, 0, doc([state(code="a")]))
    monkeypatch.setattr(I, "one_document_files", lambda lines: pytest.fail("no line failed"))
    assert process_bronze(spark, str(tmp_path), LakePaths.under(scratch("lake")))["kept"] == 1


def test_files_without_any_document_fail_and_leave_the_tables_alone(spark, scratch, tmp_path):
    lake = LakePaths.under(scratch("lake"))
    write(tmp_path, 0, indented("a"))
    process_bronze(spark, str(tmp_path), lake)
    for epoch in (None, 1716084000):
        write(tmp_path, 0, indented("a")[:50])
        with pytest.raises(UnreadableBronze, match="1 Bronze files"):
            process_bronze(spark, str(tmp_path), lake, record_epoch=epoch)
    assert codes(spark, lake.silver) == ["a"]
    write(tmp_path, 0, "")  # an empty file holds nothing that could be lost
    assert process_bronze(spark, str(tmp_path), LakePaths.under(scratch("lake")))["documents"] == 0


def test_cli_takes_an_indented_file_as_it_is(spark, scratch, tmp_path, capsys):
    write(tmp_path, 0, indented("a", "b", "", "b"))
    out = main(["run", "--bronze", str(tmp_path / NAME.format(0)), "--lake", scratch("lake"), "--record-epoch", "1716084000"], spark)
    assert out["bronze"] == {"files": 1, "bytes": out["bronze"]["bytes"], "one_document_files": 1, "documents": 1, "quarantined": 0,
                             "runs": 1, "states": 4, "kept": 2, "rejected": {"blank_aircraft_code": 1}}
    assert json.loads(capsys.readouterr().out) == out


def test_rejects_are_written_beside_silver_without_a_second_decode(spark, scratch, tmp_path):
    write(tmp_path, 0, indented("a", "", "b", lat=None) + "\n")
    write(tmp_path, 1, indented("c", "d", lat=95.0))
    lake = LakePaths.under(scratch("lake"))
    process_bronze(spark, str(tmp_path), lake)
    got = sorted((r.aircraft_code, r.reject_reason) for r in read_rejects(spark, lake).collect())
    assert got == [("", "blank_aircraft_code"), ("c", "latitude_out_of_range"), ("d", "latitude_out_of_range")]
    intake = take_in(spark, [str(tmp_path)])
    for df in (intake.silver(), intake.rejects(), intake.outcome()):
        assert not [f for f in df.inputFiles() if f.endswith(".json")]  # the written states, not the documents
    intake.close()
    assert not exists(spark, intake.scratch)


def test_a_stamped_run_that_yields_nothing_any_more_leaves_nothing(spark, scratch, tmp_path):
    lake = LakePaths.under(scratch("lake"))
    write(tmp_path, 0, indented("a", ""))
    write(tmp_path, 1, indented("b"))
    write(tmp_path, 2, '{"time": 1, "sta')
    process_bronze(spark, str(tmp_path), lake)
    assert codes(spark, lake.silver) == ["a", "b"] and spark.read.parquet(lake.quarantine).count() == 1
    other = run_directory(lake.gold_positions, 1716084060)
    files = spark.read.parquet(other).inputFiles()
    for f in tmp_path.iterdir():
        f.unlink()
    write(tmp_path, 0, doc([]))
    write(tmp_path, 2, doc([state(code="z")]))
    process_bronze(spark, str(tmp_path), lake)
    assert codes(spark, lake.silver) == ["b", "z"]
    positions, metrics = read_gold(spark, lake)
    assert sorted(r.aircraft_code for r in positions.collect()) == ["b", "z"] and metrics.count() == 2
    assert read_rejects(spark, lake).count() == 0
    quarantined = spark.read.schema("document string, run bigint").parquet(lake.quarantine)
    assert quarantined.count() == 0
    assert {(r.run % 3600 // 60, r.kept, r.rejected, r.quarantined) for r in read_runs_table(spark, lake.runs).collect()} == {(0, 0, 0, 0), (1, 1, 0, 0), (2, 1, 0, 0)}
    # the run that was not read was not written either
    assert spark.read.parquet(other).inputFiles() == files


def test_a_far_late_run_reads_two_hours(spark, scratch, monkeypatch):
    from aerolake.streaming import incremental as N

    root, out, ckpt = scratch("bronze"), scratch("silver"), scratch("ckpt")
    year = 365 * 86400
    for days in range(0, 365, 30):
        land_bronze(documents(spark, [doc([state(code=f"c{days}")])], ingest=HOUR + days * 86400), root)
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    land_bronze(documents(spark, [doc([state(code="old")])], ingest=HOUR - 86400), root)
    land_bronze(documents(spark, [doc([state(code="new")])], ingest=HOUR + year), root)
    read, real = [], N.take_in

    def watched(spark, paths, **kw):
        read.append(kw["files"].inputFiles())
        return real(spark, paths, **kw)

    monkeypatch.setattr(N, "take_in", watched)
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    (files,) = read
    hours = {f.split("/snapshot=")[0] for f in files if "/hour=" in f}
    assert len(hours) == 2
    assert len(codes(spark, out)) == 15


def test_streams_take_indented_files_and_note_their_runs(spark, scratch, tmp_path):
    root = tmp_path / "year=2024" / "month=05" / "day=19" / "hour=02"
    root.mkdir(parents=True)
    write(root, 0, indented("a", ""))
    write(root, 1, '{"time": 1, "sta')
    out, bad, rejects, runs = (scratch(n) for n in ("silver", "bad", "rejects", "runs"))
    kw = dict(quarantine_path=bad, rejects_path=rejects, runs_path=runs)
    incremental_silver(spark, str(tmp_path), out, scratch("ckpt"), **kw).awaitTermination()
    assert codes(spark, out) == ["a"] and spark.read.parquet(bad).count() == spark.read.parquet(rejects).count() == 1
    # the document is repaired: its run is read again and leaves the quarantine
    write(root, 2, indented("b"))
    (root / NAME.format(1)).write_text(doc([state(code="c")]))
    incremental_silver(spark, str(tmp_path), out, scratch("ckpt2"), **kw).awaitTermination()
    assert codes(spark, out) == ["a", "b", "c"]
    assert {(r.run % 3600 // 60, r.kept, r.quarantined) for r in read_runs_table(spark, runs).collect()} == {(0, 1, 0), (1, 1, 0), (2, 1, 0)}


def test_files_are_listed_without_being_opened(spark, scratch):
    root = scratch("bronze")
    land_texts(spark.createDataFrame([(doc([state()]), INGEST)], "value string, record_timestamp_unix bigint"), root)
    files = bronze_files(spark, [root])
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    (row,) = files.collect()
    assert row.run == INGEST and row.bytes > 0
    (same,) = read_bronze(spark, row.file, record_epoch=1).select("source_file_path").collect()
    assert same.source_file_path == row.source_file_path
    assert bronze_to_silver(read_bronze(spark, [row.file])).count() == 1
