"""Column lists, table schemas and fixed values of the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# The eleven columns of a store file, in file order, with the longest value staging accepts.
POS_LENGTHS = {
    "transaction_id": 50,
    "store_id": 10,
    "transaction_date": 30,
    "product_sku": 20,
    "product_name": 100,
    "category": 50,
    "quantity": 10,
    "unit_price": 20,
    "discount_applied": 10,
    "payment_method": 50,
    "cashier_id": 20,
}
POS_COLUMNS = list(POS_LENGTHS)
HASH_COLUMNS = ["transaction_id", "store_id", "transaction_date"]

PENDING, PASS, FAIL = "PENDING", "PASS", "FAIL"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
RUN_STARTED, RUN_ENDED = "RUN_STARTED", "RUN_ENDED"

# Rejection texts, in the order the rules apply.
DUPLICATE = "DUPLICATE"
REASONS = {
    "V01": "V01: transaction_id is null or empty",
    "V02": "V02: store_id not found in dim_store - ",
    "V03": "V03: transaction_date is not a valid datetime - ",
    "V04": "V04: product_sku not found in dim_product - ",
    "V05": "V05: unit_price is not a valid positive decimal - ",
    "V06": "V06: quantity is not a valid integer - ",
    "V07": "V07: payment_method not found in dim_payment_method - ",
}

PRICE = T.DecimalType(10, 2)
GROSS = T.DecimalType(38, 2)
MONEY = T.DecimalType(38, 4)
AVERAGE = T.DecimalType(38, 6)
RATE = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    schema = T.StructType()
    for name, kind in fields:
        schema = schema.add(name, kind)
    return schema


POS = _struct(*[(name, T.StringType()) for name in POS_COLUMNS])

STAGING = _struct(
    ("stg_id", T.LongType()),
    *[(name, T.StringType()) for name in POS_COLUMNS],
    ("source_file", T.StringType()),
    ("load_timestamp", T.TimestampNTZType()),
    ("row_hash", T.StringType()),
    ("validation_status", T.StringType()),
    ("rejection_reason", T.StringType()),
)

# Staged rows as landed: numbered by file, block and line instead of by stg_id.
LANDED = _struct(
    *[(f.name, f.dataType) for f in STAGING if f.name != "stg_id"],
    ("file_block", T.LongType()),
    ("file_row", T.LongType()),
)

FACT = _struct(
    ("sales_key", T.LongType()),
    ("date_key", T.IntegerType()),
    ("store_key", T.IntegerType()),
    ("product_key", T.IntegerType()),
    ("payment_key", T.IntegerType()),
    ("transaction_id", T.StringType()),
    ("cashier_id", T.StringType()),
    ("quantity", T.ShortType()),
    ("unit_price", PRICE),
    ("discount_applied", PRICE),
    ("source_file", T.StringType()),
    ("loaded_at", T.TimestampNTZType()),
)

DIM_STORE = _struct(
    ("store_key", T.IntegerType()),
    ("store_id", T.StringType()),
    ("store_name", T.StringType()),
    ("city", T.StringType()),
    ("region", T.StringType()),
    ("franchise_owner", T.StringType()),
    ("is_active", T.BooleanType()),
    ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()),
)

DIM_PRODUCT = _struct(
    ("product_key", T.IntegerType()),
    ("product_sku", T.StringType()),
    ("product_name", T.StringType()),
    ("category", T.StringType()),
    ("standard_price", PRICE),
    ("is_active", T.BooleanType()),
    ("created_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()),
)

DIM_PAYMENT = _struct(
    ("payment_key", T.IntegerType()),
    ("payment_method", T.StringType()),
)

DIM_DATE = _struct(
    ("date_key", T.IntegerType()),
    ("full_date", T.DateType()),
    ("day_of_week", T.ShortType()),
    ("day_name", T.StringType()),
    ("day_of_month", T.ShortType()),
    ("day_of_year", T.ShortType()),
    ("week_of_year", T.ShortType()),
    ("month_number", T.ShortType()),
    ("month_name", T.StringType()),
    ("quarter_number", T.ShortType()),
    ("year_number", T.ShortType()),
    ("is_weekend", T.BooleanType()),
    ("is_public_holiday", T.BooleanType()),
)

RUN_COUNTS = [
    "files_processed",
    "rows_staged",
    "rows_passed",
    "rows_rejected",
    "rows_loaded",
    "rows_duplicates",
]

RUN_EVENTS = _struct(
    ("run_id", T.LongType()),
    ("event", T.StringType()),
    ("event_at", T.TimestampNTZType()),
    ("run_date", T.DateType()),
    ("status", T.StringType()),
    ("files_expected", T.ShortType()),
    ("files_processed", T.ShortType()),
    ("rows_staged", T.LongType()),
    ("rows_passed", T.LongType()),
    ("rows_rejected", T.LongType()),
    ("rows_loaded", T.LongType()),
    ("rows_duplicates", T.LongType()),
    ("error_message", T.StringType()),
    ("notes", T.StringType()),
)

MISSING_FILES = _struct(
    ("log_id", T.LongType()),
    ("run_id", T.LongType()),
    ("run_date", T.DateType()),
    ("store_id", T.StringType()),
    ("expected_file", T.StringType()),
    ("logged_at", T.TimestampNTZType()),
)
