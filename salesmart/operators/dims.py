"""Dimensions: building, contracts and key lookup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmart import schema
from salesmart.operators.ids import assign_dim_keys
from salesmart.storage import Scratch

NATURAL_KEYS = {
    "store": ("store_key", "store_id"),
    "product": ("product_key", "product_sku"),
    "payment": ("payment_key", "payment_method"),
    "date": ("date_key", "full_date"),
}


@dataclass(frozen=True)
class Dims:
    """The four dimensions, as written tables: Spark then knows their size and broadcasts those below
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one gets a shuffle join whose hot keys adaptive
    execution splits."""

    store: DataFrame
    product: DataFrame
    payment: DataFrame
    date: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in NATURAL_KEYS]


class DimensionContractError(ValueError):
    """A dimension has NULL or repeated keys."""


def _stamp(df: DataFrame, now: Column | None) -> DataFrame:
    moment = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    active = F.coalesce("is_active", F.lit(True)) if "is_active" in df.columns else F.lit(True)
    return df.withColumns({"is_active": active, "created_at": moment, "updated_at": moment})


def _conform(df: DataFrame, target) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def _keyed(source: DataFrame, part: str, scratch: Scratch | None, existing: DataFrame | None) -> DataFrame:
    key, natural = NATURAL_KEYS[part]
    if key in source.columns:
        return source
    return assign_dim_keys(source, key, natural, scratch or Scratch(source.sparkSession, f"dim-{part}"), existing)


def _refreshed(built: DataFrame, existing: DataFrame | None, part: str, now: Column | None) -> DataFrame:
    """``built`` and what only ``existing`` holds: known members keep their ``created_at``, and members that left
    the source stay, inactive, so that facts still find them."""
    if existing is None:
        return built
    _, natural = NATURAL_KEYS[part]
    gone = existing.join(built.select(natural), natural, "left_anti").select(*built.columns)
    if "created_at" not in built.columns:
        return built.unionByName(gone)
    moment = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    known = existing.select(natural, F.col("created_at").alias("_since"))
    kept = built.join(known, natural, "left").withColumn("created_at", F.coalesce("_since", "created_at")).select(*built.columns)
    left = F.when(F.col("is_active"), moment).otherwise(F.col("updated_at"))
    return kept.unionByName(gone.withColumns({"updated_at": left, "is_active": F.lit(False)}))


def build_store(
    source: DataFrame, existing: DataFrame | None = None, now: Column | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Refresh: attributes from ``source``, keys and creation times of known stores kept."""
    keyed = _keyed(source, "store", scratch, existing)
    return _refreshed(_conform(_stamp(keyed, now), schema.DIM_STORE), existing, "store", now)


def build_product(
    source: DataFrame, existing: DataFrame | None = None, now: Column | None = None, scratch: Scratch | None = None
) -> DataFrame:
    keyed = _keyed(source, "product", scratch, existing)
    return _refreshed(_conform(_stamp(keyed, now), schema.DIM_PRODUCT), existing, "product", now)


def build_payment(source: DataFrame, existing: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    return _refreshed(_conform(_keyed(source, "payment", scratch, existing), schema.DIM_PAYMENT), existing, "payment", None)


def contract_violations(dims: Dims) -> DataFrame:
    """Per dimension: rows with a NULL key or natural key, and rows repeating either."""
    checks = []
    for name, df in dims.items():
        key, natural = NATURAL_KEYS[name]
        checks.append(
            df.agg(
                F.count_if(F.col(key).isNull() | F.col(natural).isNull()).alias("null_keys"),
                (F.count(key) - F.count_distinct(key)).alias("repeated_keys"),
                (F.count(natural) - F.count_distinct(natural)).alias("repeated_natural_keys"),
            ).select(F.lit(f"dim_{name}").alias("table_name"), "*")
        )
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def check_contracts(dims: Dims) -> None:
    bad = contract_violations(dims).where("null_keys + repeated_keys + repeated_natural_keys > 0").collect()
    if bad:
        raise DimensionContractError("; ".join(str(row.asDict()) for row in bad))


def row_counts(dims: Dims) -> DataFrame:
    names = {"store": "dim_store", "product": "dim_product", "date": "dim_date", "payment": "dim_payment_method"}
    counts = [
        getattr(dims, part).agg(F.count("*").alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")
        for part, table in names.items()
    ]
    report = counts[0]
    for count in counts[1:]:
        report = report.unionAll(count)
    return report


def lookup(rows: DataFrame, dims: Dims, collation: str | None = None) -> DataFrame:
    """Add store_key, product_key and payment_key; NULL where the natural key is NULL or unknown.

    ``collation`` compares natural keys under that Spark collation instead of byte by byte.
    """
    out = rows
    for part in ("store", "product", "payment"):
        key, natural = NATURAL_KEYS[part]
        keys = getattr(dims, part).select(F.col(natural).alias("_natural"), key)
        here, there = F.col(natural), F.col("_natural")
        if collation:
            here, there = F.collate(here, collation), F.collate(there, collation)
        out = out.join(keys, here == there, "left").drop("_natural")
    return out
