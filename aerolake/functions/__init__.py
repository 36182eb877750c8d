"""Column expressions shared by the operators (all JVM-side built-ins)."""

from aerolake.functions.columns import (
    airborne_flag,
    decode_position,
    grounded_flag,
    json_text,
)
from aerolake.functions.time import (
    EPOCH_NTZ,
    epoch_to_ntz,
    instant_from_path,
    ntz_to_epoch,
)

__all__ = [
    "EPOCH_NTZ",
    "airborne_flag",
    "decode_position",
    "epoch_to_ntz",
    "grounded_flag",
    "instant_from_path",
    "json_text",
    "ntz_to_epoch",
]
