"""Properties of SURVEY §5: order independence and metric invariants."""

from pyspark.sql import functions as F

from aerolake.contracts import GOLD_METRIC_COLUMNS, SILVER_COLUMNS
from aerolake.operators.gold import country_metrics
from aerolake.plans import register as R
from aerolake.plans.pipeline import bronze_to_silver
from conftest import SF_SMALL


def test_input_order_does_not_change_results(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    shuffled = events.orderBy(F.rand(7)).repartition(5)
    from aerolake.sources.events_adapter import snapshot_documents

    a = bronze_to_silver(snapshot_documents(events))
    b = bronze_to_silver(snapshot_documents(shuffled))
    assert sorted(a.select(*SILVER_COLUMNS).collect()) == sorted(b.select(*SILVER_COLUMNS).collect())
    docs = snapshot_documents(events)
    c = bronze_to_silver(docs.orderBy(F.rand(3)).repartition(3))
    ma = country_metrics(a, round_digits=6).select(*GOLD_METRIC_COLUMNS)
    mc = country_metrics(c, round_digits=6).select(*GOLD_METRIC_COLUMNS)
    assert sorted(ma.collect()) == sorted(mc.collect())


def test_metric_invariants(spark):
    m = country_metrics(R.silver(spark, SF_SMALL))
    bad = m.where(
        (F.col("airborne_flights") + F.col("grounded_flights") > F.col("total_flights"))
        | (F.col("total_flights") < 1)
    )
    assert bad.count() == 0
    assert m.count() == m.select("snapshot_timestamp", "country_of_origin", "snapshot_date", "snapshot_hour").distinct().count()


def test_fold_is_a_subset_with_unique_keys(spark):
    fold = R.serving_positions(spark, SF_SMALL)
    keys = ["aircraft_code", "position_timestamp"]
    assert fold.count() == fold.select(*keys).distinct().count()
    silver_keys = R.silver(spark, SF_SMALL).select(*keys).distinct()
    assert fold.select(*keys).exceptAll(silver_keys).count() == 0
