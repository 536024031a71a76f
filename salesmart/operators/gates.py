"""Checks that must hold before rows are appended to the fact: not-null, calendar and uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesmart.operators.dims import Dims
from salesmart.operators.lookups import attach
from salesmart.storage import Scratch, dropping_shuffles

NOT_NULL, FOREIGN_KEY, UNIQUE = "not_null", "foreign_key", "unique"
MEASURES = ["quantity", "unit_price", "discount_applied"]


class GateViolation(ValueError):
    """Rows about to be loaded break a fact constraint; nothing was appended."""


def mark_calendar(rows: DataFrame, dims: Dims) -> DataFrame:
    known = dims.date.select("date_key", F.lit(True).alias("_in_calendar"))
    return rows.join(known, "date_key", "left")


def missing_measure():
    condition = F.lit(False)
    for name in MEASURES:
        condition = condition | F.col(name).isNull()
    return condition


def repeated_ids(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("transaction_id")
        .agg(F.min("stg_id").alias("_first"), F.count("*").alias("_copies"))
        .where("_copies > 1")
    )


def violations(rows: DataFrame, dims: Dims) -> DataFrame:
    """One line per gate with the number of offending rows (for uniqueness: rows beyond the first)."""
    single_rows = mark_calendar(rows, dims).agg(
        F.count_if(missing_measure()).alias(NOT_NULL),
        F.count_if(F.col("_in_calendar").isNull()).alias(FOREIGN_KEY),
    )
    per_row = single_rows.unpivot([], [NOT_NULL, FOREIGN_KEY], "gate", "violations")
    repeats = repeated_ids(rows).agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("violations"))
    return per_row.unionByName(repeats.select(F.lit(UNIQUE).alias("gate"), "violations"))


def enforce(rows: DataFrame, dims: Dims) -> None:
    with dropping_shuffles(rows.sparkSession):
        bad = {r.gate: r.violations for r in violations(rows, dims).collect() if r.violations}
    if bad:
        raise GateViolation(f"rows violating fact constraints: {bad}")


def quarantine(rows: DataFrame, dims: Dims, scratch: Scratch, **limits: int) -> tuple[DataFrame, DataFrame]:
    """Split into loadable rows and rows held back with a reason; of repeated ids the first good row stays."""
    marked = mark_calendar(rows, dims).withColumn(
        "rejection_reason",
        F.when(missing_measure(), F.lit("GATE: a fact measure is not a valid number")).when(
            F.col("_in_calendar").isNull(), F.concat(F.lit("GATE: date is outside the calendar - "), "date_key")
        ),
    )
    marked = scratch.table(marked.drop("_in_calendar"), "gated")
    good = marked.where(F.col("rejection_reason").isNull())
    good = attach(good, repeated_ids(good), "transaction_id", "_copies", "stg_id", scratch, **limits)
    good = good.withColumn(
        "rejection_reason",
        F.when(F.col("stg_id") > F.col("_first"), F.concat(F.lit("GATE: transaction_id is repeated - "), "transaction_id")),
    ).drop("_first")
    held = good.where(F.col("rejection_reason").isNotNull()).unionByName(
        marked.where(F.col("rejection_reason").isNotNull()), allowMissingColumns=True
    )
    return good.where(F.col("rejection_reason").isNull()).drop("rejection_reason"), held
