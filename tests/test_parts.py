"""Ids, calendar, rounding, dimensions, staging, marts, run log."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import staged
from salesmart.functions import calendar
from salesmart.functions.measures import with_measures
from salesmart.functions.rounding import mean_truncated, ratio_half_up
from salesmart.operators import dims as dim_ops, staging
from salesmart.operators.dims import Dims
from salesmart.operators.ids import assign_ids
from salesmart.plans import marts, quality, runlog
from salesmart.schema import FACT
from salesmart.storage import Scratch


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v[0]).cast(v[1]).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


def test_ids_follow_the_order_without_gaps_even_when_one_value_is_hot(spark, scratch):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    rows = assign_ids(df.repartition(5), "n", scratch, ["k", "id"], start=11).collect()
    want = sorted(rows, key=lambda r: (r.k, r.id))
    assert [r.n for r in want] == list(range(11, 3011))


def test_ids_without_order_are_unique_and_dense(spark, scratch):
    rows = assign_ids(spark.range(500).repartition(7), "n", scratch).select("n").collect()
    assert sorted(r.n for r in rows) == list(range(1, 501))


def test_ids_of_no_rows(spark, scratch):
    assert assign_ids(spark.range(0), "n", scratch, ["id"]).count() == 0


def test_ratio_is_not_rounded_twice(spark):
    """123499.9960 / 10000000.00 * 100 is 1.2349..; a six-digit quotient would turn it into 1.24."""
    top, bottom = ("123499.9960", "decimal(38,4)"), ("10000000.00", "decimal(38,2)")
    ratio = ratio_half_up(F.col("a") * 100, F.col("b"), top_digits=4, bottom_digits=2)
    assert one(spark, ratio, a=top, b=bottom) == Decimal("1.23")
    naive = F.round(F.col("a") / F.col("b") * 100, 2)
    assert one(spark, naive, a=top, b=bottom) != Decimal("1.23")


@pytest.mark.parametrize(
    "top, bottom, want",
    [("1.0050", 1, "1.01"), ("-1.0050", 1, "-1.01"), ("1.0049", 1, "1.00"), ("-2.0000", 3, "-0.67"), ("0.0000", 7, "0.00"),
     ("1234567890123456.1250", 1, "1234567890123456.13"), ("5.0000", 0, None), ("-1.0000", -3, "0.33")],
)
def test_ratio_half_up(spark, top, bottom, want):
    got = one(spark, ratio_half_up(F.col("a"), F.col("b")), a=(top, "decimal(38,4)"), b=(bottom, "bigint"))
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize("total, count, want", [("2.0000", 3, "0.666666"), ("-2.0000", 3, "-0.666666"), ("10.0000", 4, "2.500000")])
def test_mean_is_cut(spark, total, count, want):
    got = one(spark, mean_truncated(F.col("a"), F.col("n")), a=(total, "decimal(38,4)"), n=(count, "bigint"))
    assert got == Decimal(want)


def test_calendar_edges(spark):
    days = {r.full_date: r for r in calendar.build(spark).collect()}
    assert len(days) == 1461
    eve = days[dt.date(2024, 12, 30)]
    assert (eve.date_key, eve.day_of_week, eve.day_name, eve.week_of_year, eve.year_number) == (20241230, 1, "Monday", 1, 2024)
    leap = days[dt.date(2024, 2, 29)]
    assert (leap.day_of_year, leap.month_name, leap.quarter_number, leap.is_weekend) == (60, "February", 1, False)
    assert days[dt.date(2025, 1, 5)].is_weekend and days[dt.date(2025, 1, 5)].day_of_week == 7


def test_calendar_holidays(spark):
    holidays = spark.createDataFrame([(dt.date(2025, 3, 17),)], "full_date date")
    rows = calendar.build(spark, "2025-03-16", "2025-03-18", holidays).orderBy("date_key").collect()
    assert [r.is_public_holiday for r in rows] == [False, True, False]


def test_row_hash_keeps_nulls_apart_from_shifted_values(spark, scratch):
    rows = staged(spark, scratch, {"transaction_id": None, "store_id": "S01"}, {"transaction_id": "S01", "store_id": None})
    first, second = [r.row_hash for r in rows.orderBy("stg_id").collect()]
    assert first != second and first == first.upper() and len(first) == 64


def test_staging_blanks_and_lengths(spark, scratch):
    rows = staged(spark, scratch, {"cashier_id": "", "category": " "}, {"quantity": "12345678901"})
    first = rows.where("stg_id = 1").first()
    assert first.cashier_id is None and first.category == " "
    with pytest.raises(staging.OverlongValueError, match="quantity"):
        staging.check_lengths(rows)
    fits, overlong = staging.check_lengths(rows, "quarantine")
    assert fits.count() == 1 and overlong.first().rejection_reason.startswith("LENGTH: quantity")


def test_retention_boundary(spark, scratch):
    rows = staged(spark, scratch, {}, {}, {}).withColumns(
        {
            "validation_status": F.when(F.col("stg_id") == 3, "PASS").otherwise("FAIL"),
            "load_timestamp": F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") - F.make_interval(secs=(F.col("stg_id") - 1).cast("decimal(18,6)")),
        }
    )
    kept = staging.retain(rows, F.lit("2025-01-08 00:00:00").cast("timestamp_ntz"))
    assert [r.stg_id for r in kept.collect()] == [1]


def test_dimension_refresh_keeps_keys(spark, dims):
    columns = "store_id string, store_name string, city string, region string, franchise_owner string"
    source = spark.createDataFrame(
        [("S12", "New name", "Athlone", "Leinster", "New Owner"), ("S13", "Second", "Cork", "Munster", "Ryan Group"), ("S00", "First", "Cork", "Munster", "X")],
        columns,
    )
    fresh = {r.store_id: r for r in dim_ops.build_store(source, dims.store).collect()}
    assert {k: fresh[k].store_key for k in ("S12", "S00", "S13")} == {"S12": 12, "S00": 13, "S13": 14}
    assert {k: r.store_key for k, r in fresh.items() if not r.is_active} == {f"S{n:02d}": n for n in range(1, 12)}
    assert fresh["S12"].franchise_owner == "New Owner"


def test_dimension_contract(spark, dims):
    dim_ops.check_contracts(dims)
    broken = Dims(dims.store.unionByName(dims.store.limit(1)), dims.product, dims.payment, dims.date)
    with pytest.raises(dim_ops.DimensionContractError, match="dim_store"):
        dim_ops.check_contracts(broken)


def test_lookup_gives_the_same_keys_when_a_dimension_is_too_big_to_broadcast(spark, dims, scratch):
    rows = staged(spark, scratch, {}, {"store_id": None}, {"product_sku": "X"}, {"payment_method": "Cash"})
    keys = ["stg_id", "store_key", "product_key", "payment_key"]
    want = sorted(map(tuple, dim_ops.lookup(rows, dims).select(*keys).collect()), key=str)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert sorted(map(tuple, dim_ops.lookup(rows, dims).select(*keys).collect()), key=str) == want
    finally:
        spark.conf.set(threshold, before)


def make_fact(spark, scratch, rows):
    """rows: (date_key, store_key, product_key, payment_key, quantity, price, discount, cashier)"""
    names = [f.name for f in FACT]
    filled = [
        dict.fromkeys(names) | dict(
            sales_key=i, date_key=d, store_key=s, product_key=p, payment_key=m, transaction_id=f"T{i}", cashier_id=c,
            quantity=q, unit_price=Decimal(price), discount_applied=Decimal(off), source_file="f",
        )
        for i, (d, s, p, m, q, price, off, c) in enumerate(rows, 1)
    ]
    return scratch.table(spark.createDataFrame([tuple(r[n] for n in names) for r in filled], FACT), "fact")


def test_measures_have_the_declared_types(spark, scratch):
    fact = with_measures(make_fact(spark, scratch, [(20250105, 1, 1, 1, 3, "2.50", "0.10", None)]))
    kinds = dict(fact.dtypes)
    assert [kinds[c] for c in ("gross_revenue", "discount_amount", "net_revenue")] == ["decimal(16,2)", "decimal(27,4)", "decimal(28,4)"]
    row = fact.first()
    assert (row.gross_revenue, row.discount_amount, row.net_revenue) == (Decimal("7.50"), Decimal("0.7500"), Decimal("6.7500"))


def test_daily_mart_counts_refunds_and_cashiers(spark, dims, scratch):
    fact = make_fact(
        spark,
        scratch,
        [(20250105, 1, 1, 1, 2, "3.00", "0.00", "C1"), (20250105, 1, 2, 1, -1, "3.00", "0.50", "C1"), (20250105, 1, 2, 1, 1, "1.00", "0.00", None)],
    )
    row = marts.daily_store(fact, dims).first()
    assert (row.total_transactions, row.total_items_sold, row.active_cashiers, row.refund_count) == (3, 2, 1, 1)
    assert (row.net_revenue, row.refund_value, row.avg_transaction_value) == (Decimal("5.5"), Decimal("-1.5"), Decimal("1.833333"))
    assert (row.sale_date, row.store_id, row.is_weekend) == (dt.date(2025, 1, 5), "S01", True)


def test_weekly_mart_leaves_refunds_out_and_guards_zero_revenue(spark, dims, scratch):
    fact = make_fact(
        spark,
        scratch,
        [(20250106, 1, 1, 1, 2, "0.00", "0.00", None), (20250108, 1, 1, 1, 2, "0.00", "0.10", None), (20250109, 1, 1, 1, -5, "9.00", "0.00", None)],
    )
    row = marts.weekly_product(fact, dims).first()
    assert (row.week_start, row.week_end, row.times_sold, row.total_quantity) == (dt.date(2025, 1, 6), dt.date(2025, 1, 8), 2, 4)
    assert (row.discount_rate_pct, row.net_revenue_per_unit) == (Decimal("0.00"), Decimal("0.00"))


def test_week_one_spans_a_calendar_year_unless_iso_years_are_asked_for(spark, dims, scratch):
    fact = make_fact(spark, scratch, [(20240102, 1, 1, 1, 1, "1.00", "0", None), (20241231, 1, 1, 1, 1, "1.00", "0", None)])
    row = marts.weekly_product(fact, dims).first()
    assert (row.year_number, row.week_of_year, row.week_start, row.week_end) == (2024, 1, dt.date(2024, 1, 2), dt.date(2024, 12, 31))
    assert sorted(r.year_number for r in marts.weekly_product(fact, dims, iso_year=True).collect()) == [2024, 2025]


def test_tied_payment_methods_go_by_name(spark, dims, scratch):
    fact = make_fact(
        spark,
        scratch,
        [(20250105, 1, 1, method, 1, "1.00", "0", None) for method in (2, 2, 4, 4, 3)] + [(20250106, 2, 1, 3, 1, "1.00", "0", None)],
    )
    top = marts.top_payment_method(fact, dims).first()
    assert (top.top_payment_method, top.method_transactions) == ("Apple Pay", 2)
    month = marts.region_month(fact, dims).first()
    assert (month.top_payment_method, month.store_count, month.trading_days, month.total_transactions) == ("Apple Pay", 2, 2, 6)
    assert (month.net_revenue_per_store, month.net_revenue_per_day) == (Decimal("3.00"), Decimal("3.00"))


def test_region_mart_scans_the_fact_once(spark, dims, scratch):
    fact = make_fact(spark, scratch, [(20250105, 1, 1, 1, 1, "1.00", "0", None)])
    plan = marts.region_month(fact, dims)._jdf.queryExecution().executedPlan().toString()
    assert sum("unit_price" in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_marts_read_only_the_columns_they_need(spark, dims, scratch):
    fact = make_fact(spark, scratch, [(20250105, 1, 1, 1, 1, "1.00", "0", None)])
    plan = marts.weekly_product(fact, dims)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "unit_price" in line)
    assert "transaction_id" not in scan and "cashier_id" not in scan and "GreaterThan(quantity,0)" in scan


def test_drill_across_keeps_both_sides(spark):
    left = spark.createDataFrame([(1, 1, 5)], "date_key int, store_key int, a int")
    right = spark.createDataFrame([(1, 2, 7)], "date_key int, store_key int, b int")
    rows = sorted(map(tuple, marts.drill_across(left, right).collect()))
    assert rows == [(1, 1, 5, None), (1, 2, None, 7)]


def test_views(spark, dims, scratch):
    marts.register_views(make_fact(spark, scratch, [(20250105, 1, 1, 1, 1, "1.00", "0", None)]), dims)
    for view in ("vw_daily_sales_by_store", "vw_weekly_product_mix", "vw_regional_revenue_summary"):
        assert spark.sql(f"SELECT count(*) AS n FROM {view}").first().n == 1


def test_run_log_folds_events(spark):
    day, start = dt.date(2025, 1, 5), dt.datetime(2025, 1, 6, 6, 0, 0, 900000)
    end = dt.datetime(2025, 1, 6, 6, 0, 9, 100000)
    counts = dict(files_processed=11, rows_staged=10, rows_passed=8, rows_rejected=2, rows_loaded=8, rows_duplicates=1)
    events = runlog.start(spark, 1, day, 12, start).unionByName(runlog.start(spark, 2, day, 12, start))
    events = events.unionByName(runlog.finish(spark, 1, end, "FAILED", error_message="lost"))
    events = events.unionByName(runlog.finish(spark, 1, end + dt.timedelta(seconds=1), counts=counts))
    missing = spark.createDataFrame([(1,)], "run_id long")
    runs = runlog.fold(events, missing)
    last, first = runlog.summary(runs).collect()
    assert (last.run_id, last.status, last.duration_seconds, last.files_missing) == (2, "RUNNING", None, None)
    assert (first.status, first.files_missing, first.rows_loaded, first.duration_seconds, first.error_message) == ("SUCCESS", 1, 8, 10, None)
    assert runlog.run_row(runs, 1).first().run_id == 1
    late = F.lit("2025-01-06 07:00:01").cast("timestamp_ntz")
    assert [r.run_id for r in quality.stuck_runs(runs, late).collect()] == [2]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        Scratch(Session())
