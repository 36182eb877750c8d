import json

from aerolake.__main__ import main
from aerolake.contracts import GOLD_POSITIONS
from aerolake.plans import register as R
from aerolake.sinks.lake import land_bronze
from aerolake.sinks.serving import read_serving
from conftest import SF_SMALL
from fixtures import HOUR, state


def test_live_runs_publish_to_serving(spark, scratch, tmp_path):
    f = tmp_path / "flight_snapshot_2024-05-19_02-00-00.json"
    f.write_text(json.dumps({"time": HOUR, "states": [state(code="a"), state(code="b")]}, indent=4))
    lake, serving = scratch("lake"), scratch("serving")
    args = ["run", "--bronze", str(f), "--lake", lake, "--serving", serving, "--multi-line"]
    r1 = main(args + ["--record-epoch", "1716084000"], spark)
    assert r1["serving"]["gold_flight_positions"] == {"inserted_count": 2, "updated_count": 0}
    # the same snapshot seen again an hour later: both keys are updated, metrics keyed by feed time too
    r2 = main(args + ["--record-epoch", "1716087600"], spark)
    assert r2["serving"]["gold_flight_positions"] == {"inserted_count": 0, "updated_count": 2}
    assert r2["serving"]["gold_country_metrics"] == {"inserted_count": 0, "updated_count": 1}
    assert read_serving(spark, f"{serving}/gold_flight_positions", GOLD_POSITIONS).count() == 2


def test_replay_publishes_the_fold(spark, scratch):
    root = scratch("bronze")
    land_bronze(R.documents(spark, SF_SMALL), root, zone="America/Recife")
    lake, serving = scratch("lake"), scratch("serving")
    main(["replay", "--bronze", root, "--lake", lake, "--serving", serving, "--zone", "America/Recife"], spark)
    got = read_serving(spark, f"{serving}/gold_flight_positions", GOLD_POSITIONS).select(*GOLD_POSITIONS.columns)
    expected = R.serving_positions(spark, SF_SMALL)
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0
