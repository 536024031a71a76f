"""Row hash over the natural key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesmart.schema import HASH_COLUMNS


def row_hash(*columns: Column) -> Column:
    """Upper-case SHA-256 of the key texts joined by '|', NULL as empty (``concat_ws`` would drop it)."""
    columns = columns or tuple(F.col(name) for name in HASH_COLUMNS)
    parts: list[Column] = []
    for column in columns:
        parts += [F.lit("|"), F.coalesce(column, F.lit(""))]
    return F.upper(F.sha2(F.concat(*parts[1:]), 256))
