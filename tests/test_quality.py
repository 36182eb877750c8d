import re

import pytest
from pyspark.sql import functions as F

from aerolake.contracts import GOLD_METRICS, GOLD_POSITIONS
from aerolake.operators.gold import country_metrics
from aerolake.operators.quality import CheckedTable, contract_violations, tables_violations
from aerolake.operators.silver import typed_positions
from aerolake.plans.pipeline import bronze_to_silver
from aerolake.sources.bronze import decode_documents
from fixtures import doc, documents, state
from plan_utils import plan_text


def test_violations_before_and_after_filters(spark):
    states = [state(code=None), state(code="x" * 11), state(code="a"), state(code="a"),
              state(code="b", call="C" * 21)]
    docs = documents(spark, [doc(states)])
    typed = typed_positions(decode_documents(docs))
    v = {r.rule: r.violations for r in contract_violations(typed, GOLD_POSITIONS, batch_columns=["ingested_at"]).collect()}
    assert v["not_null:aircraft_code"] == 1
    assert v["max_len:aircraft_code"] == 1 and v["max_len:flight_callsign"] == 1
    assert v["unique_key"] == 1
    silver = bronze_to_silver(docs)
    v2 = {r.rule: r.violations for r in contract_violations(silver, GOLD_POSITIONS, batch_columns=["ingested_at"]).collect()}
    assert v2["not_null:aircraft_code"] == 0 and v2["unique_key"] == 0
    m = country_metrics(silver, keep_run=True)
    v3 = {r.rule: r.violations for r in contract_violations(m, GOLD_METRICS, batch_columns=["ingested_at"]).collect()}
    assert all(n == 0 for n in v3.values())


def test_several_tables_in_one_pass(spark):
    """The same counts as table by table: repeated rows, null keys, an empty table, a column named like a counter."""
    states = [state(code=None), state(code=None), state(code="x" * 11), state(code="a"), state(code="a"), state(code="a"), state(code="b", call="C" * 21)]
    docs = documents(spark, [doc(states)])
    typed = typed_positions(decode_documents(docs)).withColumn("c0", F.lit(7)).withColumn("key", F.lit("k"))
    metrics = country_metrics(bronze_to_silver(docs), keep_run=True)
    run = ["ingested_at"]
    tables = [
        CheckedTable(typed, GOLD_POSITIONS, run, "typed"),
        CheckedTable(typed.limit(0), GOLD_POSITIONS, run, "none"),
        CheckedTable(metrics.unionByName(metrics), GOLD_METRICS, run),
        CheckedTable(typed, GOLD_POSITIONS, label="all runs"),
    ]
    got = sorted(tables_violations(tables).collect())
    want = [contract_violations(t.rows, t.contract, batch_columns=t.batch_columns, label=t.name) for t in tables]
    assert got == sorted(r for w in want for r in w.collect())
    found = {(r.table_name, r.rule): r.violations for r in got}
    assert found["typed", "unique_key"] == 2 and found["typed", "not_null:aircraft_code"] == 2 and found[GOLD_METRICS.name, "unique_key"] > 0
    assert all(n == 0 for (t, _), n in found.items() if t == "none")
    with pytest.raises(ValueError, match="differ"):
        tables_violations([tables[0], tables[0]])


def test_written_tables_are_checked_with_one_shuffle_of_keys(spark, tmp_path):
    typed_positions(decode_documents(documents(spark, [doc([state(code="a")])]))).write.parquet(f"{tmp_path}/typed")
    rows = spark.read.parquet(f"{tmp_path}/typed")
    tables = [CheckedTable(rows, GOLD_POSITIONS, ["ingested_at"], "typed"), CheckedTable(country_metrics(rows, keep_run=True), GOLD_METRICS, ["ingested_at"])]
    # the keys, the tables, and the metrics' own grouping
    assert len(re.findall(r"(?m)^\(\d+\) Exchange", plan_text(tables_violations(tables)))) == 3


def test_ddl_text():
    ddl = GOLD_POSITIONS.ddl()
    assert '"aircraft_code" VARCHAR(10) NOT NULL' in ddl
    assert 'PRIMARY KEY ("aircraft_code", "position_timestamp")' in ddl
    assert '"snapshot_hour" INTEGER NOT NULL' in GOLD_METRICS.ddl()
