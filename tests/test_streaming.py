from aerolake.contracts import SILVER_COLUMNS
from aerolake.plans import register as R
from aerolake.plans.pipeline import bronze_to_silver
from aerolake.sinks.lake import land_bronze, read_lake_table
from aerolake.streaming import incremental_silver
from conftest import SF_SMALL
from fixtures import HOUR, doc, documents, state


def test_available_now_processes_only_new_files(spark, scratch):
    root, out, ckpt = scratch("bronze"), scratch("silver"), scratch("ckpt")
    docs = R.documents(spark, SF_SMALL)
    land_bronze(docs, root)
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    cols = [c for c in SILVER_COLUMNS if c != "source_file_path"]
    first = read_lake_table(spark, out, cols)
    expected = bronze_to_silver(docs).select(*cols)
    assert sorted(first.collect()) == sorted(expected.collect())
    # rerun with nothing new adds nothing
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    assert read_lake_table(spark, out).count() == expected.count()
    # a new run lands; only it is processed
    new = documents(spark, [doc([state(code="zz")])], ingest=HOUR + 10 * 86400)
    land_bronze(new, root)
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    assert read_lake_table(spark, out).count() == expected.count() + 1


def test_late_run_is_accepted_in_batch_mode(spark, scratch):
    root, out, ckpt = scratch("bronze"), scratch("silver"), scratch("ckpt")
    land_bronze(documents(spark, [doc([state(code="new")])], ingest=HOUR + 86400), root)
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    # a run from a day earlier lands afterwards: it is processed, not dropped
    land_bronze(documents(spark, [doc([state(code="old")])], ingest=HOUR), root)
    incremental_silver(spark, root, out, ckpt).awaitTermination()
    got = sorted(r.aircraft_code for r in read_lake_table(spark, out).collect())
    assert got == ["new", "old"]


def test_archive_moves_processed_files(spark, scratch):
    import os

    root, out, ckpt, archive = scratch("bronze"), scratch("silver"), scratch("ckpt"), scratch("archive")
    land_bronze(documents(spark, [doc([state(code="a")])]), root)
    incremental_silver(spark, root, out, ckpt, archive_dir=archive).awaitTermination()
    land_bronze(documents(spark, [doc([state(code="b")])], ingest=HOUR + 86400), root)
    incremental_silver(spark, root, out, ckpt, archive_dir=archive).awaitTermination()
    assert sorted(r.aircraft_code for r in read_lake_table(spark, out).collect()) == ["a", "b"]
    archived = [f for _, _, fs in os.walk(archive.replace("file:", "")) for f in fs if f.endswith(".txt") or f.endswith(".json")]
    assert archived, "processed Bronze files are archived"


def test_run_split_over_micro_batches_equals_one_run(spark, scratch):
    from aerolake.contracts import GOLD_METRICS
    from aerolake.sinks.serving import read_serving

    root, out, ckpt, serving, gm = (scratch(n) for n in ("bronze", "silver", "ckpt", "serving", "metrics"))
    # two files of one run; "b" is in both, the newer contact in the first
    land_bronze(documents(spark, [doc([state(code="a"), state(code="b", contact=HOUR + 9, vel=1.0)])]), root)
    land_bronze(documents(spark, [doc([state(code="b", vel=2.0), state(code="c"), state(code="d")])]), root)
    kw = dict(max_files_per_trigger=1, gold_metrics_path=gm, serving_root=serving)
    incremental_silver(spark, root, out, ckpt, **kw).awaitTermination()
    got = {r.aircraft_code: r.velocity for r in read_lake_table(spark, out).collect()}
    assert got == {"a": 200.0, "b": 1.0, "c": 200.0, "d": 200.0}
    assert read_lake_table(spark, out).count() == 4
    assert [r.total_flights for r in read_lake_table(spark, gm).collect()] == [4]
    published = read_serving(spark, f"{serving}/gold_country_metrics", GOLD_METRICS).collect()
    assert [r.total_flights for r in published] == [4]
    # the whole stream again, as after a lost checkpoint: runs replace themselves
    incremental_silver(spark, root, out, scratch("ckpt2"), **kw).awaitTermination()
    assert read_lake_table(spark, out).count() == 4


def test_run_split_by_the_archive_is_whole(spark, scratch):
    root, out, ckpt, archive = (scratch(n) for n in ("bronze", "silver", "ckpt", "archive"))
    for codes in ("ab", "cd", "e"):
        land_bronze(documents(spark, [doc([state(code=c) for c in codes])]), root)
        incremental_silver(spark, root, out, ckpt, archive_dir=archive).awaitTermination()
    assert sorted(r.aircraft_code for r in read_lake_table(spark, out).collect()) == list("abcde")


def test_corrupt_documents_go_to_quarantine_or_fail_the_stream(spark, scratch):
    import pytest

    from aerolake.sinks.lake import land_texts
    from fixtures import INGEST

    root, out = scratch("bronze"), scratch("silver")
    texts = spark.createDataFrame([(doc([state(code="a")]), INGEST), ('{"time": 1, "sta', INGEST)], "value string, record_timestamp_unix bigint")
    land_texts(texts, root)
    with pytest.raises(Exception, match="quarantine_path"):
        incremental_silver(spark, root, out, scratch("ckpt")).awaitTermination()
    bad = scratch("bad")
    incremental_silver(spark, root, out, scratch("ckpt"), quarantine_path=bad).awaitTermination()
    assert [r.aircraft_code for r in read_lake_table(spark, out).collect()] == ["a"]
    assert [(r.document, r.run) for r in spark.read.parquet(bad).collect()] == [('{"time": 1, "sta', INGEST)]


def test_unstamped_file_fails(spark, tmp_path):
    import pytest

    from aerolake.sources.bronze import read_bronze

    (tmp_path / "positions.json").write_text(doc([state()]))
    with pytest.raises(Exception, match="no run instant"):
        bronze_to_silver(read_bronze(spark, str(tmp_path))).collect()
    assert bronze_to_silver(read_bronze(spark, str(tmp_path), record_epoch=HOUR)).count() == 1


def test_stream_continues_to_gold_and_serving(spark, scratch):
    from aerolake.contracts import GOLD_METRIC_COLUMNS, GOLD_POSITIONS
    from aerolake.operators.gold import country_metrics
    from aerolake.sinks.serving import read_serving

    root, out, ckpt = scratch("bronze"), scratch("silver"), scratch("ckpt")
    gp, gm, serving = scratch("gold-pos"), scratch("gold-met"), scratch("serving")
    docs = R.documents(spark, SF_SMALL)
    land_bronze(docs, root)
    kw = dict(gold_positions_path=gp, gold_metrics_path=gm, serving_root=serving, round_digits=6)
    incremental_silver(spark, root, out, ckpt, **kw).awaitTermination()
    silver = bronze_to_silver(docs)
    assert read_lake_table(spark, gp).count() == silver.count()
    met = read_lake_table(spark, gm, GOLD_METRIC_COLUMNS)
    assert sorted(met.collect()) == sorted(country_metrics(silver, round_digits=6).collect())
    got = read_serving(spark, f"{serving}/gold_flight_positions", GOLD_POSITIONS).select(*GOLD_POSITIONS.columns)
    assert got.exceptAll(R.serving_positions(spark, SF_SMALL)).count() == 0
    assert got.count() == R.serving_positions(spark, SF_SMALL).count()


def _counted_intakes(monkeypatch):
    """Files of every intake of the stream, in turn."""
    from aerolake.streaming import incremental as S

    counts, take_in = [], S.take_in

    def counting(*args, **kw):
        taken = take_in(*args, **kw)
        counts.append(taken.counts["files"])
        return taken

    monkeypatch.setattr(S, "take_in", counting)
    return counts


def test_files_of_a_split_run_are_read_once(spark, scratch, monkeypatch):
    counts = _counted_intakes(monkeypatch)
    root, out, ckpt = scratch("bronze"), scratch("silver"), scratch("ckpt")
    for codes in ("ab", "cd", "e"):
        land_bronze(documents(spark, [doc([state(code=c) for c in codes])]), root)
    kw = dict(max_files_per_trigger=1)
    incremental_silver(spark, root, out, ckpt, **kw).awaitTermination()
    assert sorted(r.aircraft_code for r in read_lake_table(spark, out).collect()) == list("abcde")
    assert counts == [3]
    # a file that lands after that makes its run be read again, whole
    land_bronze(documents(spark, [doc([state(code="f")])]), root)
    incremental_silver(spark, root, out, ckpt, **kw).awaitTermination()
    assert sorted(r.aircraft_code for r in read_lake_table(spark, out).collect()) == list("abcdef")
    assert counts == [3, 4]


def test_file_read_ahead_that_changed_since_is_read_again(spark, scratch, monkeypatch):
    import glob
    import os

    from aerolake.plans import pipeline
    from aerolake.streaming import incremental as S

    counts = _counted_intakes(monkeypatch)
    root, out = scratch("bronze"), scratch("silver")
    land_bronze(documents(spark, [doc([state(code="a")])]), root)
    first = set(glob.glob(f"{root}/**/*.json", recursive=True))
    land_bronze(documents(spark, [doc([state(code="b")])]), root)
    (second,) = set(glob.glob(f"{root}/**/*.json", recursive=True)) - first
    os.utime(first.pop(), (1_700_000_000, 1_700_000_000))  # the first is named first

    def written_then_changed(intake, lake, **kw):
        done = pipeline.write_intake(intake, lake, **kw)
        if len(counts) == 1:
            crc = os.path.join(os.path.dirname(second), f".{os.path.basename(second)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
            with open(second, "w") as f:
                f.write(doc([state(code="b"), state(code="c")]))
        return done

    monkeypatch.setattr(S, "write_intake", written_then_changed)
    incremental_silver(spark, root, out, scratch("ckpt"), max_files_per_trigger=1).awaitTermination()
    assert sorted(r.aircraft_code for r in read_lake_table(spark, out).collect()) == ["a", "b", "c"]
    assert counts == [2, 2]
