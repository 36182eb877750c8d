"""Bronze sources: landed JSON snapshots and the ``events`` snapshot adapter."""

from aerolake.sources.bronze import (
    BRONZE_READ_SCHEMA,
    corrupt_documents,
    decode_documents,
    decode_states,
    explode_states,
    parse_documents,
    read_bronze,
)
from aerolake.sources.events_adapter import snapshot_documents

__all__ = [
    "BRONZE_READ_SCHEMA",
    "corrupt_documents",
    "decode_documents",
    "decode_states",
    "explode_states",
    "parse_documents",
    "read_bronze",
    "snapshot_documents",
]
