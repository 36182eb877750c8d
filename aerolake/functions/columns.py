"""Decode and flag expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(v: Column) -> Column:
    """VARIANT -> compact JSON text; a JSON ``null`` becomes SQL NULL, not ``'null'``."""
    return F.when(~F.is_variant_null(v), F.to_json(v))


def decode_position(value: Column, index: int, kind: str, strict: bool = False) -> Column:
    """Value at ``index`` of a positional VARIANT array, typed as ``kind``.

    Out-of-range positions are NULL (short vectors are padded).  Numbers given
    as text are parsed (``"12.3"`` -> 12.3); text that is not a number is NULL,
    or raises ``INVALID_VARIANT_CAST`` when ``strict``.
    """
    get = F.variant_get if strict else F.try_variant_get
    path = f"$[{index}]"
    if kind == "json":
        return json_text(F.try_variant_get(value, path, "variant"))
    return get(value, path, kind)


def grounded_flag(on_ground: Column) -> Column:
    """1 when the object reports being on the ground, else 0 (NULL counts 0)."""
    return F.when(on_ground == F.lit(True), 1).otherwise(0)


def airborne_flag(on_ground: Column) -> Column:
    """1 when the object reports being airborne, else 0 (NULL counts 0)."""
    return F.when(on_ground == F.lit(False), 1).otherwise(0)
