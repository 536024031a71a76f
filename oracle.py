"""DuckDB SQL for every registered query, written independently of the Spark code.

All statements share the derivation of FIXTURES.md section 3 as common table expressions.
"""

from __future__ import annotations

POS = [
    "transaction_id", "store_id", "transaction_date", "product_sku", "product_name", "category",
    "quantity", "unit_price", "discount_applied", "payment_method", "cashier_id",
]
POS_SQL = ", ".join(POS)
LOAD_TIME = "TIMESTAMP '2026-01-01 06:00:00'"


def smallint(s: str) -> str:
    return f"CASE WHEN regexp_full_match({s}, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim({s}) AS SMALLINT) END"


def price(s: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({s}, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)\\s*') "
        f"THEN TRY_CAST(trim({s}) AS DECIMAL(10,2)) END"
    )


def moment(s: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({s}, "
        f"'\\s*[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]+)?)?)?\\s*') "
        f"THEN TRY_CAST(trim({s}) AS TIMESTAMP) END"
    )


def whole(x: str, digits: int) -> str:
    """A decimal as an integer count of its last digit."""
    return f"CAST(CAST({x} AS DECIMAL(28,{digits})) * {10**digits} AS HUGEINT)" if digits else f"CAST({x} AS HUGEINT)"


def half_up(n: str, d: str, factor: int = 1) -> str:
    """Integers n*factor/d to the nearest integer (halves away from zero), read as hundredths; NULL when d is 0."""
    return (
        f"CAST(CAST(sign({n}) * ((2 * abs({n}) * {factor} + NULLIF({d}, 0)) // (2 * NULLIF({d}, 0))) AS DECIMAL(18,0)) "
        f"* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"
    )


def mean(total: str, n: str) -> str:
    """total/n cut to six places."""
    return (
        f"CAST(CAST(({whole(total, 4)} * 100) // {n} AS DECIMAL(30,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(38,6))"
    )


NUMBERED = """
numbered AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice) AS seq,
         l.*, o_orderpriority, p_name, p_type, p_retailprice
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
placed AS (
  SELECT *, concat('S', lpad(CAST(1 + l_suppkey % 12 AS VARCHAR), 2, '0')) AS st,
         DATE '2024-01-01' + CAST((seq * 13) % 731 AS INT) AS dt,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS pr
  FROM numbered),
feed AS (
  SELECT seq AS stg_id,
    CASE WHEN seq % 107 = 0 THEN CASE WHEN seq % 2 = 0 THEN NULL ELSE '  ' END
         ELSE concat('T', lpad(CAST(seq AS VARCHAR), 9, '0')) END AS transaction_id,
    CASE WHEN seq % 139 = 0 THEN NULL WHEN seq % 109 = 0 THEN concat('X', st) ELSE st END AS store_id,
    CASE WHEN seq % 113 = 0 THEN '2025-13-40 00:00:00'
         ELSE concat(strftime(dt, '%Y-%m-%d'), ' ', lpad(CAST(7 + seq % 13 AS VARCHAR), 2, '0'), ':',
                     lpad(CAST(seq % 60 AS VARCHAR), 2, '0'), ':00') END AS transaction_date,
    CASE WHEN seq % 157 = 0 THEN NULL WHEN seq % 127 = 0 THEN 'P0UNKNOWN'
         ELSE concat('P', lpad(CAST(1 + l_partkey % 17 AS VARCHAR), 3, '0')) END AS product_sku,
    p_name AS product_name, p_type AS category,
    CASE WHEN seq % 131 = 0 THEN 'two'
         WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN CAST(-CAST(l_quantity AS INT) AS VARCHAR)
         ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
    CASE WHEN seq % 167 = 0 THEN '-1.00' WHEN seq % 103 = 0 THEN concat(pr, 'X') ELSE pr END AS unit_price,
    CAST(CAST(l_discount AS DECIMAL(10,2)) AS VARCHAR) AS discount_applied,
    CASE WHEN seq % 137 = 0 THEN 'Cheque' ELSE o_orderpriority END AS payment_method,
    CASE WHEN seq % 97 = 0 THEN NULL WHEN seq % 89 = 0 THEN '   '
         ELSE concat(st, '_C0', CAST(1 + seq % 5 AS VARCHAR)) END AS cashier_id,
    concat(st, '_sales_', strftime(dt, '%Y-%m-%d'), '.csv') AS source_file
  FROM placed
  WHERE NOT (st = 'S07' AND dt BETWEEN DATE '2024-01-31' AND DATE '2024-02-02')),
raw AS (
  SELECT * FROM feed
  UNION ALL SELECT * REPLACE (stg_id + 10000000 AS stg_id) FROM feed WHERE stg_id % 101 = 0),
staged AS (
  SELECT *, upper(sha256(concat(coalesce(transaction_id, ''), '|', coalesce(store_id, ''), '|', coalesce(transaction_date, '')))) AS row_hash
  FROM raw),
before AS (SELECT transaction_id FROM feed WHERE stg_id % 149 = 0 AND trim(transaction_id) <> '')"""

DIMS = """
dim_store AS (
  SELECT CAST(n_nationkey + 1 AS INT) AS store_key, concat('S', lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0')) AS store_id,
         concat('Store ', n_name) AS store_name, n_name AS city, r_name AS region,
         concat('OWNER_', CAST(n_nationkey % 7 AS VARCHAR)) AS franchise_owner, n_nationkey < 12 AS is_active
  FROM nation JOIN region ON r_regionkey = n_regionkey),
dim_product AS (
  SELECT CAST(1 + p_partkey % 17 AS INT) AS product_key,
         concat('P', lpad(CAST(1 + p_partkey % 17 AS VARCHAR), 3, '0')) AS product_sku,
         min(p_name) AS product_name, min(p_type) AS category,
         min(CAST(p_retailprice AS DECIMAL(10,2))) AS standard_price, true AS is_active
  FROM part GROUP BY 1, 2),
dim_payment AS (
  SELECT CAST(row_number() OVER (ORDER BY m) AS INT) AS payment_key, m AS payment_method
  FROM (SELECT DISTINCT o_orderpriority AS m FROM orders)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date,
         CAST(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name, CAST(day(d) AS SMALLINT) AS day_of_month,
         CAST(dayofyear(d) AS SMALLINT) AS day_of_year, CAST(weekofyear(d) AS SMALLINT) AS week_of_year,
         CAST(month(d) AS SMALLINT) AS month_number, monthname(d) AS month_name,
         CAST(quarter(d) AS SMALLINT) AS quarter_number, CAST(year(d) AS SMALLINT) AS year_number,
         isodow(d) >= 6 AS is_weekend, false AS is_public_holiday
  FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS d))"""

VALIDATED = f"""
keyed AS (
  SELECT s.*, store_key, product_key, payment_key,
         row_number() OVER (PARTITION BY row_hash ORDER BY stg_id) AS copy_no,
         b.transaction_id IS NOT NULL AS is_loaded
  FROM staged s
  LEFT JOIN (SELECT store_key, store_id AS k FROM dim_store) ON k = store_id
  LEFT JOIN (SELECT product_key, product_sku AS k2 FROM dim_product) ON k2 = product_sku
  LEFT JOIN (SELECT payment_key, payment_method AS k3 FROM dim_payment) ON k3 = payment_method
  LEFT JOIN before b ON b.transaction_id = s.transaction_id),
judged AS (
  SELECT *, CASE
    WHEN is_loaded OR copy_no > 1 THEN 'DUPLICATE'
    WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'V01: transaction_id is null or empty'
    WHEN store_id IS NOT NULL AND store_key IS NULL THEN concat('V02: store_id not found in dim_store - ', store_id)
    WHEN {moment("transaction_date")} IS NULL
      THEN concat('V03: transaction_date is not a valid datetime - ', coalesce(transaction_date, 'NULL'))
    WHEN product_sku IS NOT NULL AND product_key IS NULL THEN concat('V04: product_sku not found in dim_product - ', product_sku)
    WHEN coalesce({price("unit_price")}, -1) < 0
      THEN concat('V05: unit_price is not a valid positive decimal - ', coalesce(unit_price, 'NULL'))
    WHEN {smallint("quantity")} IS NULL THEN concat('V06: quantity is not a valid integer - ', coalesce(quantity, 'NULL'))
    WHEN payment_method IS NOT NULL AND payment_key IS NULL
      THEN concat('V07: payment_method not found in dim_payment_method - ', payment_method)
    END AS rejection_reason
  FROM keyed),
validated AS (SELECT *, CASE WHEN rejection_reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS validation_status FROM judged)"""

FACT = f"""
fact AS (
  SELECT CAST(strftime({moment("transaction_date")}, '%Y%m%d') AS INT) AS date_key,
         store_key, product_key, payment_key, transaction_id, NULLIF(trim(cashier_id), '') AS cashier_id,
         {smallint("quantity")} AS quantity, {price("unit_price")} AS unit_price, {price("discount_applied")} AS discount_applied,
         source_file, stg_id
  FROM validated
  WHERE validation_status = 'PASS' AND store_key IS NOT NULL AND product_key IS NOT NULL AND payment_key IS NOT NULL
    AND transaction_id NOT IN (SELECT transaction_id FROM before)),
sales AS (
  SELECT *, CAST(quantity AS DECIMAL(5,0)) * unit_price AS gross_revenue,
         CAST(CAST(quantity AS DECIMAL(5,0)) * unit_price AS DECIMAL(17,2)) * discount_applied AS discount_amount,
         CAST(CAST(quantity AS DECIMAL(5,0)) * unit_price AS DECIMAL(17,2)) * (1 - discount_applied) AS net_revenue
  FROM fact)"""

SUMS = """count(*) AS total_transactions, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
    CAST(sum(gross_revenue) AS DECIMAL(38,2)) AS gross_revenue, CAST(sum(discount_amount) AS DECIMAL(38,4)) AS total_discounts,
    CAST(sum(net_revenue) AS DECIMAL(38,4)) AS net_revenue"""

DAILY = f"""
daily AS (
  SELECT full_date AS sale_date, day_name, is_weekend, week_of_year, month_name, quarter_number, year_number,
    store_id, store_name, city, region, franchise_owner, {SUMS},
    count(DISTINCT cashier_id) AS active_cashiers,
    count(*) FILTER (quantity < 0) AS refund_count,
    CAST(sum(CASE WHEN quantity < 0 THEN net_revenue ELSE 0 END) AS DECIMAL(38,4)) AS refund_value
  FROM sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key)
  GROUP BY ALL),
daily_mart AS (SELECT *, {mean("net_revenue", "total_transactions")} AS avg_transaction_value FROM daily)"""

WEEKLY = f"""
weekly AS (
  SELECT year_number, week_of_year, min(full_date) AS week_start, max(full_date) AS week_end, region, store_id, store_name,
    product_sku, product_name, category, standard_price, {SUMS}
  FROM sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_product USING (product_key)
  WHERE quantity > 0
  GROUP BY year_number, week_of_year, region, store_id, store_name, product_sku, product_name, category, standard_price),
weekly_mart AS (
  SELECT * EXCLUDE (total_transactions, total_items_sold), total_transactions AS times_sold, total_items_sold AS total_quantity,
    coalesce({half_up(whole("total_discounts", 4), f"({whole('gross_revenue', 2)} * 100)", 10000)}, 0) AS discount_rate_pct,
    coalesce({half_up(whole("net_revenue", 4), "(CAST(total_items_sold AS HUGEINT) * 10000)", 100)}, 0) AS net_revenue_per_unit
  FROM weekly)"""

TOP_METHOD = """
methods AS (
  SELECT region, year_number, month_number, payment_method, count(*) AS n
  FROM fact JOIN dim_date USING (date_key) JOIN dim_store USING (store_key) JOIN dim_payment USING (payment_key)
  GROUP BY ALL),
top_method AS (
  SELECT region, year_number, month_number, payment_method AS top_payment_method, n AS method_transactions
  FROM methods QUALIFY row_number() OVER (PARTITION BY region, year_number, month_number ORDER BY n DESC, payment_method) = 1)"""

REGION = f"""
monthly AS (
  SELECT year_number, quarter_number, month_number, month_name, region,
    count(DISTINCT store_id) AS store_count, count(DISTINCT full_date) AS trading_days, {SUMS}
  FROM sales JOIN dim_date USING (date_key) JOIN dim_store USING (store_key)
  GROUP BY ALL),
region_mart AS (
  SELECT monthly.*, {half_up(whole("net_revenue", 4), "(CAST(store_count AS HUGEINT) * 10000)", 100)} AS net_revenue_per_store,
    {half_up(whole("net_revenue", 4), "(CAST(trading_days AS HUGEINT) * 10000)", 100)} AS net_revenue_per_day,
    {mean("net_revenue", "total_transactions")} AS avg_transaction_value, top_payment_method
  FROM monthly JOIN top_method USING (region, year_number, month_number))"""

RUNS = f"""
file_day AS (
  SELECT CAST(regexp_extract(source_file, '^(.+?)_sales_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.csv$', 2) AS DATE) AS run_date, source_file,
    count(*) AS staged, count(*) FILTER (validation_status = 'PASS') AS passed, count(*) FILTER (validation_status = 'FAIL') AS failed,
    count(*) FILTER (rejection_reason = 'DUPLICATE') AS dups
  FROM validated GROUP BY 1, 2),
run_days AS (
  SELECT run_date, date_diff('day', DATE '2024-01-01', run_date) + 1 AS run_id, count(*) AS files, sum(staged) AS staged,
    sum(passed) AS passed, sum(failed) AS failed, sum(dups) AS dups
  FROM file_day GROUP BY 1, 2),
absent AS (
  SELECT dim_store.store_id, d AS run_date FROM dim_store, (SELECT full_date AS d FROM dim_date WHERE full_date <= DATE '2025-12-31')
  WHERE is_active AND NOT EXISTS (SELECT 1 FROM staged
    WHERE staged.source_file = concat(dim_store.store_id, '_sales_', strftime(d, '%Y-%m-%d'), '.csv'))),
runs AS (
  SELECT run_id, run_date, CAST(run_date AS TIMESTAMP) + INTERVAL 30 HOUR AS pipeline_start,
    CASE WHEN run_id % 97 <> 0 THEN CAST(run_date AS TIMESTAMP) + INTERVAL 30 HOUR + to_seconds(CAST((staged * 37) % 4000 AS INT)) END AS pipeline_end,
    CASE WHEN run_id % 97 = 0 THEN 'RUNNING' WHEN run_id % 53 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST(12 AS SMALLINT) AS files_expected,
    CASE WHEN run_id % 97 <> 0 THEN CAST(files AS SMALLINT) END AS files_processed,
    CAST((SELECT NULLIF(count(*), 0) FROM absent WHERE absent.run_date = run_days.run_date) AS SMALLINT) AS files_missing,
    CASE WHEN run_id % 97 <> 0 THEN CAST(staged AS BIGINT) END AS rows_staged,
    CASE WHEN run_id % 97 <> 0 THEN CAST(passed AS BIGINT) END AS rows_passed,
    CASE WHEN run_id % 97 <> 0 THEN CAST(failed AS BIGINT) END AS rows_rejected,
    CASE WHEN run_id % 97 <> 0 THEN CAST(dups AS BIGINT) END AS rows_duplicates,
    CASE WHEN run_id % 97 <> 0 THEN CAST(passed AS BIGINT) END AS rows_loaded,
    CASE WHEN run_id % 97 <> 0 AND run_id % 53 = 0 THEN 'load failed' END AS error_message
  FROM run_days)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


FACT_COLUMNS = (
    "date_key, store_key, product_key, payment_key, transaction_id, cashier_id, quantity, unit_price, discount_applied, source_file"
)
# Store files of nine dates: a row's file is that of its quarter, a resent row's that of the next date, where it is a
# duplicate if the first copy was loaded. Copies within one date are told apart by their hash as ever.
FILED = f"""
filed AS (
  SELECT s.*, f.dt, CAST(date_diff('month', DATE '2024-01-01', f.dt) // 3 AS INT) + CASE WHEN stg_id > 10000000 THEN 1 ELSE 0 END AS day,
         concat(f.st, '_sales_', strftime(DATE '2025-03-01' + CAST(date_diff('month', DATE '2024-01-01', f.dt) // 3 AS INT)
                + CASE WHEN stg_id > 10000000 THEN 1 ELSE 0 END, '%Y-%m-%d'), '.csv') AS new_file
  FROM staged s JOIN (SELECT seq, st, dt FROM placed) f ON f.seq = s.stg_id % 10000000),
"""
# The rules on those files: first by themselves, then with what an earlier date has loaded.
RANGE = (
    FILED
    + VALIDATED.strip()
    .replace("PARTITION BY row_hash ORDER BY stg_id", "PARTITION BY day, row_hash ORDER BY stg_id")
    .replace("FROM staged s", "FROM (SELECT * REPLACE (new_file AS source_file) FROM filed) s")
    .replace("LEFT JOIN before b", "LEFT JOIN (SELECT NULL AS transaction_id) b")
    .replace("is_loaded OR copy_no > 1", "copy_no > 1")
    .replace("validated AS (SELECT *,", "alone AS (SELECT *,")
    + f""",
validated AS (
  SELECT a.* REPLACE (coalesce(CASE WHEN f.transaction_id IS NOT NULL THEN 'DUPLICATE' END, a.rejection_reason) AS rejection_reason,
    CASE WHEN f.transaction_id IS NOT NULL THEN 'FAIL' ELSE a.validation_status END AS validation_status)
  FROM alone a LEFT JOIN (
    SELECT transaction_id FROM alone WHERE stg_id < 10000000 AND validation_status = 'PASS'
      AND store_key IS NOT NULL AND product_key IS NOT NULL AND payment_key IS NOT NULL) f
    ON f.transaction_id = a.transaction_id AND a.stg_id > 10000000)"""
)
RANGE_FACT = FACT.replace("AND transaction_id NOT IN (SELECT transaction_id FROM before)", "")
TO_RANGE = (NUMBERED, DIMS, RANGE, RANGE_FACT)
TO_VALIDATED = (NUMBERED, DIMS, VALIDATED)
TO_FACT = (*TO_VALIDATED, FACT)
TO_RUNS = (*TO_VALIDATED, RUNS)

# Texts the cast query derives from each staged row, the same CASE in both engines.
QTY_TEXT = """CASE stg_id % 12 WHEN 0 THEN concat(quantity, '.0') WHEN 1 THEN concat('+', quantity) WHEN 2 THEN concat(' ', quantity, ' ')
 WHEN 3 THEN concat(quantity, 'e3') WHEN 4 THEN concat(quantity, '0000') WHEN 5 THEN '' WHEN 6 THEN '   ' ELSE quantity END"""
PRICE_TEXT = """CASE stg_id % 12 WHEN 0 THEN concat(' ', unit_price, ' ') WHEN 1 THEN concat('$', unit_price) WHEN 2 THEN concat(unit_price, '6')
 WHEN 3 THEN concat(unit_price, 'e2') WHEN 4 THEN concat('9999999', unit_price) WHEN 5 THEN '-0.001' WHEN 6 THEN '.5' WHEN 7 THEN '1,000'
 WHEN 8 THEN '3.' ELSE unit_price END"""
TIME_TEXT = """CASE stg_id % 12 WHEN 0 THEN substring(transaction_date, 1, 10) WHEN 1 THEN replace(transaction_date, ' ', 'T')
 WHEN 2 THEN substring(transaction_date, 12) WHEN 3 THEN substring(transaction_date, 1, 4) WHEN 4 THEN concat(transaction_date, '.123456')
 WHEN 5 THEN '2025-02-30 00:00:00' WHEN 6 THEN concat(' ', transaction_date) WHEN 7 THEN substring(transaction_date, 1, 16) ELSE transaction_date END"""

QUERIES: dict[str, str] = {
    "stage_normalize": _with(
        NUMBERED,
        select="SELECT stg_id, "
        + ", ".join(f"NULLIF(CASE WHEN stg_id % 11 = {i} THEN '' ELSE {c} END, '') AS {c}" for i, c in enumerate(POS))
        + " FROM raw",
    ),
    "stage_rows": _with(
        NUMBERED,
        select=f"SELECT stg_id, {POS_SQL}, source_file, {LOAD_TIME} AS load_timestamp, row_hash, 'PENDING' AS validation_status, "
        "CAST(NULL AS VARCHAR) AS rejection_reason FROM staged",
    ),
    "file_name_parse": _with(
        NUMBERED,
        select="SELECT source_file, split_part(source_file, '_sales_', 1) AS store_id, "
        "CAST(replace(split_part(source_file, '_sales_', 2), '.csv', '') AS DATE) AS business_date, count(*) AS file_rows FROM staged GROUP BY 1",
    ),
    "expected_files": _with(
        DIMS,
        select="SELECT store_id, full_date AS business_date, concat(store_id, '_sales_', strftime(full_date, '%Y-%m-%d'), '.csv') AS expected_file "
        "FROM dim_store, dim_date WHERE is_active AND full_date <= DATE '2025-12-31'",
    ),
    "missing_files": _with(
        *TO_RUNS,
        select="SELECT run_date, store_id, concat(store_id, '_sales_', strftime(run_date, '%Y-%m-%d'), '.csv') AS expected_file, "
        f"{LOAD_TIME} AS logged_at FROM absent",
    ),
    "row_hash": _with(NUMBERED, select="SELECT stg_id, row_hash FROM staged"),
    "cast_matrix": _with(
        NUMBERED,
        f"texts AS (SELECT stg_id, {QTY_TEXT} AS q, {PRICE_TEXT} AS p, discount_applied AS d, {TIME_TEXT} AS t FROM staged)",
        select=f"SELECT stg_id, {smallint('q')} AS quantity, {price('p')} AS unit_price, {price('d')} AS discount_applied, "
        f"{moment('t')} AS transaction_ts, CAST(strftime({moment('t')}, '%Y%m%d') AS INT) AS date_key FROM texts",
    ),
    "dim_store": _with(DIMS, select=f"SELECT *, {LOAD_TIME} AS created_at, {LOAD_TIME} AS updated_at FROM dim_store"),
    "dim_refresh": _with(
        DIMS,
        select="SELECT store_key, store_id, store_name, CASE WHEN store_key % 5 = 0 AND store_key < 25 THEN upper(city) || ' NEW' ELSE city END AS city, "
        f"is_active AND store_key < 25 AS is_active, {LOAD_TIME} AS created_at, "
        f"CASE WHEN store_key = 25 THEN {LOAD_TIME} ELSE TIMESTAMP '2026-02-01 00:00:00' END AS updated_at FROM dim_store "
        "UNION ALL SELECT 26, 'S26', 'Store 26', 'NEWTOWN', true, TIMESTAMP '2026-02-01 00:00:00', TIMESTAMP '2026-02-01 00:00:00'",
    ),
    "dim_product": _with(DIMS, select=f"SELECT *, {LOAD_TIME} AS created_at, {LOAD_TIME} AS updated_at FROM dim_product"),
    "dim_payment": _with(DIMS, select="SELECT * FROM dim_payment"),
    "dim_date": _with(
        *TO_FACT,
        select="SELECT dim_date.*, count(transaction_id) AS fact_rows FROM dim_date LEFT JOIN fact USING (date_key) GROUP BY ALL",
    ),
    "dim_row_counts": _with(
        DIMS,
        select="SELECT 'dim_store' AS table_name, count(*) AS row_count FROM dim_store UNION ALL SELECT 'dim_product', count(*) FROM dim_product "
        "UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_payment_method', count(*) FROM dim_payment",
    ),
    "dim_contracts": _with(
        DIMS,
        select="SELECT t AS table_name, CAST(n - count_k AS BIGINT) AS null_keys, CAST(count_k - dk AS BIGINT) AS repeated_keys, "
        "CAST(n - dn AS BIGINT) AS repeated_natural_keys FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS t, count(*) AS n, count({k}) AS count_k, count(DISTINCT {k}) AS dk, count(DISTINCT {nk}) AS dn FROM {t}"
            for t, k, nk in [
                ("dim_store", "store_key", "store_id"),
                ("dim_product", "product_key", "product_sku"),
                ("dim_payment", "payment_key", "payment_method"),
                ("dim_date", "date_key", "full_date"),
            ]
        )
        + ")",
    ),
    "surrogate_keys": _with(
        NUMBERED, select="SELECT stg_id, 1000 + row_number() OVER (ORDER BY source_file, stg_id) AS row_key FROM staged"
    ),
    "dedupe_in_batch": _with(
        NUMBERED,
        select="SELECT stg_id, transaction_id, stg_id > min(stg_id) OVER (PARTITION BY row_hash) AS is_batch_dup FROM staged",
    ),
    "dedupe_vs_fact": _with(
        NUMBERED,
        select="SELECT stg_id, transaction_id, coalesce(transaction_id IN (SELECT transaction_id FROM before), false) AS is_loaded FROM staged",
    ),
    "validate_rows": _with(
        *TO_VALIDATED,
        select=f"SELECT stg_id, {POS_SQL}, source_file, {LOAD_TIME} AS load_timestamp, row_hash, validation_status, rejection_reason, "
        "store_key, product_key, payment_key FROM validated",
    ),
    "validation_summary": _with(
        *TO_VALIDATED, select="SELECT validation_status, count(*) AS row_count FROM validated GROUP BY 1"
    ),
    "fact_load": _with(*TO_FACT, select=f"SELECT {FACT_COLUMNS} FROM fact"),
    "fact_load_idempotent": _with(
        *TO_FACT,
        select="SELECT 'first' AS attempt, count(*) AS rows_loaded, (SELECT count(*) FROM validated WHERE validation_status = 'FAIL') AS rows_rejected FROM fact "
        "UNION ALL SELECT 'second', 0, (SELECT count(*) FROM validated v WHERE v.rejection_reason IS NOT NULL OR v.transaction_id IN (SELECT transaction_id FROM fact))",
    ),
    "load_metrics": _with(
        *TO_FACT,
        "p AS (SELECT count(*) AS rows_passed, count(*) FILTER (store_key IS NULL OR product_key IS NULL OR payment_key IS NULL) AS rows_unresolved "
        "FROM validated WHERE validation_status = 'PASS')",
        select="SELECT rows_passed, rows_unresolved, rows_passed - rows_unresolved - (SELECT count(*) FROM fact) AS rows_already_present, "
        "(SELECT count(*) FROM fact) AS rows_loaded FROM p",
    ),
    "fact_measures": _with(
        *TO_FACT,
        select="SELECT transaction_id, CAST(gross_revenue AS DECIMAL(16,2)) AS gross_revenue, CAST(discount_amount AS DECIMAL(27,4)) AS discount_amount, "
        "CAST(net_revenue AS DECIMAL(28,4)) AS net_revenue FROM sales",
    ),
    "gate_violations": _with(
        *TO_FACT,
        "risky AS (SELECT stg_id, CASE WHEN stg_id % 211 = 0 THEN 19990101 ELSE date_key END AS date_key, "
        "CASE WHEN stg_id % 223 = 0 THEN NULL ELSE discount_applied END AS discount_applied, "
        "CASE WHEN stg_id % 3 = 0 THEN 'SHARED' ELSE transaction_id END AS transaction_id, quantity, unit_price FROM fact)",
        select="SELECT 'not_null' AS gate, count(*) FILTER (quantity IS NULL OR unit_price IS NULL OR discount_applied IS NULL) AS violations FROM risky "
        "UNION ALL SELECT 'foreign_key', count(*) FILTER (date_key NOT IN (SELECT date_key FROM dim_date)) FROM risky "
        "UNION ALL SELECT 'unique', count(*) - count(DISTINCT transaction_id) FROM risky",
    ),
    "gate_quarantine": _with(
        *TO_FACT,
        "risky AS (SELECT stg_id, CASE WHEN stg_id % 211 = 0 THEN 19990101 ELSE date_key END AS date_key, "
        "CASE WHEN stg_id % 223 = 0 THEN NULL ELSE discount_applied END AS discount_applied, "
        "CASE WHEN stg_id % 3 = 0 THEN 'SHARED' ELSE transaction_id END AS transaction_id FROM fact), "
        "row_gate AS (SELECT *, CASE WHEN discount_applied IS NULL THEN 'GATE: a fact measure is not a valid number' "
        "WHEN date_key = 19990101 THEN 'GATE: date is outside the calendar - 19990101' END AS why FROM risky), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id, why IS NULL ORDER BY stg_id) AS nth FROM row_gate)",
        select="SELECT stg_id, coalesce(why, concat('GATE: transaction_id is repeated - ', transaction_id)) AS rejection_reason "
        "FROM ranked WHERE why IS NOT NULL OR nth > 1",
    ),
    "mart_daily_store": _with(*TO_FACT, DAILY, select="SELECT * FROM daily_mart"),
    "mart_weekly_product": _with(*TO_FACT, WEEKLY, select="SELECT * FROM weekly_mart"),
    "mart_weekly_product_iso": _with(
        *TO_FACT,
        WEEKLY.replace("SELECT year_number, week_of_year, min", "SELECT CAST(isoyear(full_date) AS SMALLINT) AS year_number, week_of_year, min").replace(
            "GROUP BY year_number,", "GROUP BY isoyear(full_date),"
        ),
        select="SELECT * FROM weekly_mart",
    ),
    "mart_region_month": _with(*TO_FACT, TOP_METHOD, REGION, select="SELECT * FROM region_mart"),
    "top_payment_method": _with(*TO_FACT, TOP_METHOD, select="SELECT * FROM top_method"),
    "top_store_days": _with(
        *TO_FACT,
        DAILY,
        select="SELECT sale_date, store_id, store_name, total_transactions, net_revenue, avg_transaction_value FROM daily_mart "
        "ORDER BY sale_date DESC, net_revenue DESC, store_id LIMIT 5",
    ),
    "top_product_weeks": _with(
        *TO_FACT,
        WEEKLY,
        select="SELECT week_start, store_id, store_name, product_sku, product_name, total_quantity, net_revenue, discount_rate_pct FROM weekly_mart "
        "ORDER BY week_start DESC, net_revenue DESC, store_id, product_sku, year_number, week_of_year LIMIT 5",
    ),
    "region_report": _with(
        *TO_FACT,
        TOP_METHOD,
        REGION,
        select="SELECT year_number, month_number, month_name, region, store_count, total_transactions, net_revenue, net_revenue_per_store, "
        "top_payment_method FROM region_mart",
    ),
    "drill_across": _with(
        *TO_FACT,
        "s AS (SELECT date_key, store_key, count(*) AS sale_count, CAST(sum(net_revenue) AS DECIMAL(38,4)) AS sale_net FROM sales GROUP BY ALL)",
        "o AS (SELECT CAST(strftime(DATE '2024-01-01' + CAST(o_orderkey % 731 AS INT), '%Y%m%d') AS INT) AS date_key, "
        "CAST(1 + o_custkey % 12 AS INT) AS store_key, count(*) AS order_count, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS order_total FROM orders GROUP BY ALL)",
        select="SELECT * FROM s FULL JOIN o USING (date_key, store_key)",
    ),
    "rejection_rate": _with(
        *TO_RUNS,
        select="SELECT source_file, staged AS total_rows, passed, failed, "
        f"{half_up('CAST(failed AS HUGEINT)', 'staged', 10000)} AS rejection_rate_pct FROM file_day",
    ),
    "reject_reasons": _with(
        *TO_VALIDATED,
        select="SELECT rejection_reason, count(*) AS occurrences FROM validated WHERE validation_status = 'FAIL' GROUP BY 1",
    ),
    "reject_codes": _with(
        *TO_VALIDATED,
        select="SELECT split_part(rejection_reason, ':', 1) AS rejection_reason, count(*) AS occurrences FROM validated "
        "WHERE validation_status = 'FAIL' GROUP BY 1",
    ),
    "reject_reasons_by_file": _with(
        *TO_VALIDATED,
        select="SELECT source_file, rejection_reason, count(*) AS rejected_rows FROM validated WHERE validation_status = 'FAIL' GROUP BY 1, 2",
    ),
    "dup_by_file": _with(
        *TO_VALIDATED,
        select="SELECT source_file, count(*) AS duplicate_rows FROM validated WHERE rejection_reason = 'DUPLICATE' GROUP BY 1",
    ),
    "staging_retention": _with(
        *TO_VALIDATED,
        select="SELECT stg_id, validation_status, rejection_reason, CAST(DATE '2026-01-01' - CAST(stg_id % 15 AS INT) AS TIMESTAMP) "
        "+ INTERVAL 6 HOUR AS load_timestamp FROM validated WHERE validation_status = 'FAIL' AND stg_id % 15 <= 7",
    ),
    "run_counts": _with(
        *TO_FACT,
        RUNS,
        select="SELECT count(*) AS files_processed, count(*) AS files_validated, CAST(sum(staged) AS BIGINT) AS rows_staged, "
        "CAST(sum(passed) AS BIGINT) AS rows_passed, CAST(sum(failed) AS BIGINT) AS rows_rejected, CAST(sum(dups) AS BIGINT) AS rows_duplicates, "
        "(SELECT count(*) FROM fact) AS rows_loaded, CAST(sum(passed) AS BIGINT) AS rows_loadable FROM file_day",
    ),
    "run_summary": _with(
        *TO_RUNS,
        select="SELECT run_id, run_date, status, files_expected, files_processed, files_missing, rows_staged, rows_passed, rows_rejected, "
        "rows_duplicates, rows_loaded, date_diff('second', pipeline_start, pipeline_end) AS duration_seconds, error_message "
        "FROM runs ORDER BY run_id DESC LIMIT 7",
    ),
    "run_log": _with(*TO_RUNS, select="SELECT * FROM runs"),
    "stuck_runs": _with(
        *TO_RUNS,
        select="SELECT run_id, run_date, pipeline_start, status FROM runs WHERE status = 'RUNNING' AND pipeline_start < TIMESTAMP '2025-06-01 00:00:00'",
    ),
    "sla_report": _with(
        *TO_RUNS,
        "rates AS (SELECT run_date, "
        f"max({half_up('CAST(failed AS HUGEINT)', 'staged', 10000)}) AS worst_rejection_pct, "
        f"max({half_up('CAST(dups AS HUGEINT)', 'staged', 10000)}) AS worst_duplicate_pct, "
        "count(*) FILTER (failed * 100 >= staged * 5) AS stores_over_rejection, count(*) FILTER (dups * 100 >= staged * 3) AS stores_over_duplicates "
        "FROM file_day GROUP BY 1)",
        select="SELECT run_id, run_date, status, status = 'SUCCESS' AND pipeline_end <= CAST(run_date AS TIMESTAMP) + INTERVAL 31 HOUR AS completed_on_time, "
        "worst_rejection_pct, worst_duplicate_pct, stores_over_rejection, stores_over_duplicates, files_missing IS NULL AS no_file_missing, "
        "coalesce(files_missing, 0) > 2 AS missing_alert, "
        "coalesce(date_diff('second', pipeline_start, pipeline_end) > 1800, false) AS duration_alert FROM runs JOIN rates USING (run_date)",
    ),
    "freshness": _with(
        *TO_FACT, select=f"SELECT max(date_key) AS latest_date_key, {LOAD_TIME} AS latest_load FROM fact"
    ),
    "fact_load_two_writers": _with(*TO_FACT, select=f"SELECT {FACT_COLUMNS} FROM fact"),
    "clear_staging": _with(
        *TO_VALIDATED,
        select="SELECT stg_id, validation_status, rejection_reason, CAST(DATE '2026-01-01' - CAST(stg_id % 15 AS INT) AS TIMESTAMP) "
        "+ INTERVAL 6 HOUR AS load_timestamp FROM validated WHERE validation_status = 'FAIL' AND stg_id % 15 <= 7",
    ),
    "backfill_range": _with(*TO_RANGE, select=f"SELECT {FACT_COLUMNS} FROM fact"),
    "backfill_rejects": _with(
        *TO_RANGE,
        select="SELECT source_file, rejection_reason, count(*) AS rejected_rows FROM validated WHERE validation_status = 'FAIL' GROUP BY 1, 2",
    ),
    "backfill_runs": _with(
        *TO_RANGE,
        select="SELECT CAST(day + 1 AS BIGINT) AS run_id, CAST(DATE '2025-03-01' + day AS DATE) AS run_date, 'SUCCESS' AS status, "
        "CAST((SELECT count(*) FROM dim_store WHERE is_active) AS SMALLINT) AS files_expected, CAST(count(DISTINCT v.source_file) AS SMALLINT) AS files_processed, "
        "CAST(NULLIF((SELECT count(*) FROM dim_store WHERE is_active) - count(DISTINCT v.source_file), 0) AS SMALLINT) AS files_missing, "
        "count(*) AS rows_staged, count(*) FILTER (validation_status = 'PASS') AS rows_passed, count(*) FILTER (validation_status = 'FAIL') AS rows_rejected, "
        "count(*) FILTER (rejection_reason = 'DUPLICATE') AS rows_duplicates, "
        "count(*) FILTER (v.stg_id IN (SELECT stg_id FROM fact)) AS rows_loaded FROM validated v GROUP BY day",
    ),
    "stream_files_load": _with(*TO_RANGE, select=f"SELECT {FACT_COLUMNS.replace(', source_file', '')} FROM fact"),
    "stream_hourly_late": "WITH marked AS (SELECT *, event_id % 7 = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= "
    "(SELECT max(ts) FROM events WHERE event_id % 7 <> 0) - INTERVAL 1 HOUR AS is_late FROM events) "
    "SELECT date_trunc('hour', ts) AS hour_start, event_type, is_late, count(*) AS sales, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_sum FROM marked GROUP BY 1, 2, 3",
    "stream_load": _with(*TO_FACT, select=f"SELECT {FACT_COLUMNS} FROM fact"),
    "stream_load_mixed": _with(*TO_FACT, select=f"SELECT {FACT_COLUMNS} FROM fact"),
    "stream_hourly_sales": "SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS sales, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_sum FROM events GROUP BY 1, 2",
}
