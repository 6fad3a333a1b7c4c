"""Value mappings: whitelists, defaults, label encoding and decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitelist(c: Column | str, allowed: Sequence[str]) -> Column:
    """Keep values in ``allowed`` (case-sensitive), anything else → null."""
    c = _col(c)
    return F.when(c.isin(list(allowed)), c)


def map_with_default(c: Column | str, mapping: dict[str, str], default: str) -> Column:
    """Map exact values through ``mapping``; everything else (null too) → default."""
    c = _col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(default) if out is not None else F.lit(default)


def encode_label(c: Column | str, positive: str = "yes", negative: str = "no") -> Column:
    """Case-insensitive ``yes`` → 1, ``no`` → 0, anything else → null (int)."""
    low = F.lower(_col(c))
    return F.when(low == positive, 1).when(low == negative, 0).otherwise(None).cast("int")


def decode_label(c: Column | str = "prediction", positive: str = "Yes", negative: str = "No") -> Column:
    """Prediction 1 → ``Yes``, anything else → ``No``."""
    return F.when(_col(c) == 1, positive).otherwise(negative)
