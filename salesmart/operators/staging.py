"""Staging: normalise, stamp, check lengths, append, retain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart import schema
from salesmart.functions.hashing import row_hash
from salesmart.schema import FAIL, PENDING, POS_COLUMNS, POS_LENGTHS


class OverlongValueError(ValueError):
    """A source value does not fit its staging column."""


def normalize_empty(df: DataFrame) -> DataFrame:
    """Empty text becomes NULL in the eleven source columns; whitespace is kept."""
    return df.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in POS_COLUMNS})


def overlong_reason() -> Column:
    """Names the first column whose value is too long, else NULL."""
    return F.coalesce(
        *[
            F.when(F.length(name) > size, F.lit(f"LENGTH: {name} is longer than {size} characters"))
            for name, size in POS_LENGTHS.items()
        ]
    )


def check_lengths(df: DataFrame, on_violation: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Split into rows that fit and rows that do not; by default the latter must be none."""
    marked = df.withColumn("rejection_reason", overlong_reason())
    fits = marked.where(F.col("rejection_reason").isNull()).drop("rejection_reason")
    overlong = marked.where(F.col("rejection_reason").isNotNull())
    if on_violation == "fail":
        example = F.min(F.struct("source_file", "rejection_reason")).alias("example")
        bad = overlong.agg(F.count("*").alias("bad"), example).first()
        if bad.bad:
            raise OverlongValueError(f"{bad.bad} rows, such as {bad.example.source_file}: {bad.example.rejection_reason}")
    return fits, overlong


def stage(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Normalised rows with provenance, row hash and PENDING status.

    Expects source_file, and stg_id or (for rows just read) file_block and file_row.
    """
    target = schema.STAGING if "stg_id" in df.columns else schema.LANDED
    moment = load_ts if load_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    return (
        normalize_empty(df)
        .withColumns(
            {
                "load_timestamp": moment,
                "row_hash": row_hash(),
                "validation_status": F.lit(PENDING),
                "rejection_reason": F.lit(None).cast("string"),
            }
        )
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
    )


def retain(df: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """What clearing leaves behind: failed rows no older than ``days``."""
    keep_from = now - F.make_interval(days=F.lit(days))
    return df.where((F.col("validation_status") == FAIL) & (F.col("load_timestamp") >= keep_from))


def remaining_rejects(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("remaining_rejected_rows"))
