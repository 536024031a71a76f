"""Fact load: resolve keys, cast, insert-only merge on transaction_id, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart import schema
from salesmart.functions.casts import blank_to_null, date_key, to_decimal, to_smallint, to_ts
from salesmart.operators import gates
from salesmart.operators.dims import Dims, lookup
from salesmart.operators.validate import KEYS, mark_loaded
from salesmart.schema import PASS
from salesmart.storage import Scratch

FACT_INPUT = [f.name for f in schema.FACT if f.name not in ("sales_key", "loaded_at")]


def clean_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("validation_status") == PASS)


def resolve_keys(rows: DataFrame, dims: Dims, collation: str | None = None) -> DataFrame:
    """Inner-join semantics: rows with a NULL or unknown natural key drop out.

    Validation has already looked the keys up, so they are only looked up again when absent.
    """
    keyed = rows if set(KEYS) <= set(rows.columns) else lookup(rows, dims, collation)
    return keyed.dropna(subset=KEYS)


def to_fact_types(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_moment", to_ts(F.col("transaction_date"))).select(
        "stg_id",
        date_key(F.col("_moment")).alias("date_key"),
        *KEYS,
        "transaction_id",
        blank_to_null(F.col("cashier_id")).alias("cashier_id"),
        to_smallint(F.col("quantity")).alias("quantity"),
        to_decimal(F.col("unit_price")).alias("unit_price"),
        to_decimal(F.col("discount_applied")).alias("discount_applied"),
        "source_file",
    )


def merge_insert(rows: DataFrame, fact_ids: DataFrame, scratch: Scratch, **limits: int) -> DataFrame:
    """Rows whose transaction id the fact does not hold yet."""
    return mark_loaded(rows, fact_ids, scratch, **limits).where(~F.col("is_loaded")).drop("is_loaded")


def new_rows(
    validated: DataFrame, fact_ids: DataFrame | None, dims: Dims, scratch: Scratch, **limits: int
) -> DataFrame:
    """Typed rows ready for the gates; still carries stg_id.

    ``fact_ids=None`` skips the merge check: validation against the same fact has already failed every
    row whose id is loaded, so a second pass over the fact's ids would find nothing.
    """
    typed = to_fact_types(resolve_keys(clean_rows(validated), dims))
    return typed if fact_ids is None else merge_insert(typed, fact_ids, scratch, **limits)


def run(
    validated: DataFrame,
    fact_ids: DataFrame | None,
    dims: Dims,
    scratch: Scratch,
    on_violation: str = "fail",
    **limits: int,
) -> tuple[DataFrame, DataFrame | None]:
    """Gated rows and, when quarantining, the rows held back. ``validated`` should be a written table:
    the rows are worked out from it again when they are appended, which costs less than writing them twice."""
    pending = new_rows(validated, fact_ids, dims, scratch, **limits)
    if on_violation == "fail":
        gates.enforce(pending, dims)
        return pending, None
    limits.pop("row_count", None)  # of the rows before the gates
    return gates.quarantine(pending, dims, scratch, **limits)


def metrics(validated: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows passed, of those without a key, already present, and loaded."""
    unresolved = F.col("store_key").isNull() | F.col("product_key").isNull() | F.col("payment_key").isNull()
    passed = validated.agg(
        F.count_if(F.col("validation_status") == PASS).alias("rows_passed"),
        F.count_if((F.col("validation_status") == PASS) & unresolved).alias("rows_unresolved"),
    )
    counted = loaded.agg(F.count("*").alias("rows_loaded"))
    both = passed.unionByName(counted, allowMissingColumns=True)
    return both.agg(*[F.sum(name).alias(name) for name in ("rows_passed", "rows_unresolved", "rows_loaded")]).select(
        "rows_passed",
        "rows_unresolved",
        (F.col("rows_passed") - F.col("rows_unresolved") - F.col("rows_loaded")).alias("rows_already_present"),
        "rows_loaded",
    )


def to_fact(rows: DataFrame, first_key: int = 1, loaded_at: Column | None = None) -> DataFrame:
    """Fact column order and types. Keys follow stg_id, with gaps where rows were rejected, so that
    numbering takes no pass over the data."""
    moment = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    stamped = rows.withColumns({"sales_key": F.col("stg_id") + F.lit(first_key - 1), "loaded_at": moment})
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.FACT])
