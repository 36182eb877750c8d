import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.operators.quality import DuplicateKeyError, assert_unique_keys
from aerolake.operators.upsert import (
    fold_latest,
    insert_ignore,
    insert_ignore_counts,
    merge_counts,
    upsert,
)

SCHEMA = "k string, v bigint"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_insert_and_update(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    batch = spark.createDataFrame([("b", 20), ("c", 30)], SCHEMA)
    assert rows(upsert(target, batch, ["k"])) == [("a", 1), ("b", 20), ("c", 30)]
    c = merge_counts(target, batch, ["k"]).collect()[0]
    assert (c.inserted_count, c.updated_count) == (1, 1)


def test_upsert_again_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    batch = spark.createDataFrame([("b", 20), ("c", 30)], SCHEMA)
    once = upsert(target, batch, ["k"])
    twice = upsert(once, batch, ["k"])
    assert rows(twice) == rows(once)
    c = merge_counts(once, batch, ["k"]).collect()[0]
    assert (c.inserted_count, c.updated_count) == (0, 2)


def test_insert_ignore_all_columns_are_keys(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], SCHEMA)
    batch = spark.createDataFrame([("b", 2), ("b", 5), (None, 3)], SCHEMA)
    out = {(r.k, r.v) for r in insert_ignore(target, batch).collect()}
    assert out == {("a", 1), ("b", 2), ("b", 5), (None, 3)}
    assert insert_ignore(target, batch).count() == 4
    c = insert_ignore_counts(target, batch).collect()[0]
    assert (c.inserted_count, c.updated_count) == (1, 0)


def test_duplicate_key_in_batch_raises(spark):
    batch = spark.createDataFrame([("b", 20), ("b", 21)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        assert_unique_keys(batch, ["k"])
    assert_unique_keys(spark.createDataFrame([("b", 20)], SCHEMA), ["k"])


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 9)), max_size=6,
                 unique_by=lambda t: t[0]),
        min_size=1, max_size=4,
    )
)
def test_fold_equals_sequential_upserts(spark, runs):
    history = [(k, v, run) for run, batch in enumerate(runs) for k, v in batch]
    if not history:
        return
    hist = spark.createDataFrame(history, "k string, v bigint, run int")
    folded = rows(fold_latest(hist, ["k"], ["run"], ["k", "v"]))
    state: dict[str, int] = {}
    for batch in runs:
        state.update(dict(batch))
    assert folded == sorted(state.items())


def test_result_invariant_to_input_order(spark):
    target = spark.createDataFrame([(f"k{i}", i) for i in range(50)], SCHEMA)
    batch = spark.createDataFrame([(f"k{i}", -i) for i in range(25, 75)], SCHEMA)
    a = rows(upsert(target, batch, ["k"]))
    b = rows(upsert(target.orderBy("v").repartition(7), batch.repartition(3), ["k"]))
    assert a == b and len(a) == 75


def test_serving_upsert_touches_only_batch_partitions(spark, scratch):
    from aerolake.contracts import GOLD_POSITIONS
    from aerolake.operators.quality import DuplicateKeyError
    from aerolake.plans.pipeline import bronze_to_silver
    from aerolake.sinks.serving import read_serving, upsert_serving
    from fixtures import HOUR, doc, documents, state

    day = 86400
    first = bronze_to_silver(documents(spark, [doc([state(code="a", tpos=HOUR), state(code="b", tpos=HOUR - day)])]))
    path = scratch("serving")
    assert upsert_serving(spark, path, first, GOLD_POSITIONS) == {"inserted_count": 2, "updated_count": 0}
    def files_of(code):
        df = spark.read.parquet(path).where(F.col("aircraft_code") == code)
        return sorted(r.f for r in df.select(F.input_file_name().alias("f")).collect())

    b_files = files_of("b")
    second = bronze_to_silver(documents(spark, [doc([state(code="a", tpos=HOUR, vel=9.0), state(code="c", tpos=HOUR)])]))
    assert upsert_serving(spark, path, second, GOLD_POSITIONS) == {"inserted_count": 1, "updated_count": 1}
    out = {r.aircraft_code: r.velocity for r in read_serving(spark, path, GOLD_POSITIONS).collect()}
    assert out == {"a": 9.0, "b": 200.0, "c": 200.0}
    # the partition of "b" (the day before) was not rewritten
    assert files_of("b") == b_files
    dup = bronze_to_silver(documents(spark, [doc([state(code="z")])]))
    with pytest.raises(DuplicateKeyError):
        upsert_serving(spark, path, dup.unionByName(dup), GOLD_POSITIONS)


def test_newer_than_guard_keeps_newer_rows(spark):
    s3 = "k string, v bigint, ts bigint"
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 10)], s3)
    batch = spark.createDataFrame([("a", 100, 5), ("b", 200, 20), ("c", 300, 1)], s3)
    out = rows(upsert(target, batch, ["k"], newer_than="ts"))
    assert out == [("a", 1, 10), ("b", 200, 20), ("c", 300, 1)]
    c = merge_counts(target, batch, ["k"], newer_than="ts").collect()[0]
    assert (c.inserted_count, c.updated_count) == (1, 1)
    # without the guard the older row overwrites
    assert rows(upsert(target, batch, ["k"]))[0] == ("a", 100, 5)
