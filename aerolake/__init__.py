"""Position-snapshot medallion analytics on Spark.

Bronze JSON snapshots are decoded into typed rows with VARIANT functions,
validated and de-duplicated into Silver, summarised into Gold, and published
by keyed upsert.  Every step is a ``DataFrame -> DataFrame`` function built
from Spark's own operators; sinks are separate.
"""

from aerolake.operators.gold import (
    busiest_countries,
    country_metrics,
    gold_positions,
    latest_positions,
)
from aerolake.operators.quality import CheckedTable, assert_unique_keys, contract_violations, tables_violations
from aerolake.operators.silver import (
    dedup_positions,
    rejected_positions,
    typed_positions,
    valid_positions,
)
from aerolake.operators.upsert import fold_latest, insert_ignore, merge_counts, upsert
from aerolake.plans.pipeline import (
    LakePaths,
    bronze_to_silver,
    publish_serving,
    replay_bronze,
    run_medallion,
    silver_to_gold,
)
from aerolake.sinks.lake import land_bronze, read_lake_table, write_partitioned
from aerolake.sinks.serving import register_serving_views, upsert_serving
from aerolake.sources.bronze import decode_documents, parse_documents, read_bronze

__version__ = "0.1.0"

__all__ = [
    "LakePaths",
    "assert_unique_keys",
    "bronze_to_silver",
    "busiest_countries",
    "contract_violations",
    "CheckedTable",
    "tables_violations",
    "country_metrics",
    "decode_documents",
    "dedup_positions",
    "fold_latest",
    "gold_positions",
    "insert_ignore",
    "land_bronze",
    "latest_positions",
    "merge_counts",
    "parse_documents",
    "publish_serving",
    "read_bronze",
    "read_lake_table",
    "register_serving_views",
    "rejected_positions",
    "replay_bronze",
    "run_medallion",
    "silver_to_gold",
    "typed_positions",
    "upsert",
    "upsert_serving",
    "valid_positions",
    "write_partitioned",
]
