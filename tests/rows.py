"""Hand-written store rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.operators import staging

BASE = {
    "transaction_id": "T1",
    "store_id": "S01",
    "transaction_date": "2025-01-05 10:00:00",
    "product_sku": "HOT003",
    "product_name": "Flat White",
    "category": "Hot Drinks",
    "quantity": "1",
    "unit_price": "3.50",
    "discount_applied": "0.00",
    "payment_method": "Card",
    "cashier_id": "S01_C01",
    "source_file": "S01_sales_2025-01-05.csv",
}
MOMENT = dt.datetime(2025, 1, 6, 6)


def staged(spark, scratch, *changes: dict):
    """One staged row per change to the base row; ids default to T1, T2, .."""
    rows = []
    for number, change in enumerate(changes, 1):
        row = BASE | {"transaction_id": f"T{number}"} | change
        rows.append((number, *row.values()))
    schema = "stg_id long, " + ", ".join(f"{name} string" for name in BASE)
    df = staging.stage(spark.createDataFrame(rows, schema), F.lit(MOMENT).cast("timestamp_ntz"))
    return scratch.table(df, "staged")


def ids(spark, *values: str):
    return spark.createDataFrame([(v,) for v in values], "transaction_id string")
