"""Surrogate ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from salesmart.operators.lookups import is_small
from salesmart.storage import DENSE, Scratch

# monotonically_increasing_id() keeps the partition number above these bits and the row number below.
_ROW_BITS = 33


def assign_ids(
    df: DataFrame,
    id_name: str,
    scratch: Scratch,
    order: list[str] | None = None,
    start: int = 1,
) -> DataFrame:
    """Gap-free ids from ``start``, following ``order`` (or, without it, the rows as they are partitioned).

    The rows are range-partitioned and sorted once and written with their (partition, row) position;
    only one row count per partition is then summed up. No task sees more than its own range, and a
    hot value of one order column is split as long as the whole order is unique.
    """
    placed = df.orderBy(*order) if order else df
    placed = scratch.table(placed.withColumn("_position", F.monotonically_increasing_id()), id_name, **DENSE)
    return number_positions(placed, id_name, start)


def number_positions(placed: DataFrame, id_name: str, start: int = 1) -> DataFrame:
    """Turn the ``_position`` column of a written table into gap-free ids."""
    part = F.shiftrightunsigned("_position", _ROW_BITS)
    row = F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition of the written table, so the single-task running sum below stays small.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(id_name, F.lit(start).cast("long") + F.col("_offset") + row)
        .drop("_part", "_position", "_offset")
    )


def number_lines(
    rows: DataFrame, id_name: str, start: int = 1, max_splits: int = 1_000_000, before: list[str] | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Gap-free ids in file and line order for rows read from files and written once.

    ``file_row`` counts up by one along a split (a file, or one block of it), so only the first value
    and the size of each split are needed: the rows are neither sorted nor shuffled. ``before`` are columns of a file that
    come before its name in that order. With ``scratch`` the sizes are written, for a result that is read more than once.
    """
    split = [*(before or []), "source_file", "file_block"]
    sizes = rows.groupBy(*split).agg(F.min("file_row").alias("_first"), F.count("*").alias("_rows"))
    sizes = scratch.table(sizes, "splits") if scratch else sizes
    # One row per split.
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*split, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    if is_small(sizes, max_splits):
        offsets = F.broadcast(offsets)
    number = F.lit(start).cast("long") + F.col("_offset") + F.col("file_row") - F.col("_first")
    return rows.join(offsets, split).withColumn(id_name, number).drop("_first", "_offset", "file_block", "file_row")


def assign_dim_keys(
    df: DataFrame, key: str, natural: str, scratch: Scratch, existing: DataFrame | None = None
) -> DataFrame:
    """Keep the keys of known natural values and number new ones, by name, after the largest."""
    if existing is None:
        return assign_ids(df, key, scratch, [natural])
    known = existing.select(natural, key)
    top = known.agg(F.max(key)).first()[0] or 0
    kept = df.join(known, natural)
    fresh = assign_ids(df.join(known, natural, "left_anti"), key, scratch, [natural], start=top + 1)
    return kept.unionByName(fresh.select(*kept.columns))
