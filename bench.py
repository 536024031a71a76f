"""Times the registered queries on BENCH_SF_DIR with local[BENCH_CPUS] and prints one JSON line.

The derived tables (staged rows, validated rows, fact, dimensions) are built first, as the warehouse
would have them stored; each query then writes its whole result to a sink that discards it. ``run_day`` is a
whole daily run over twelve store files of 260 sales, from reading to archiving. The value counts all of it.
"""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart import fixtures  # noqa: E402
from salesmart.functions import calendar  # noqa: E402
from salesmart.operators.dims import Dims  # noqa: E402
from salesmart.plans import daily  # noqa: E402
from salesmart.plans.catalog import QUERIES  # noqa: E402
from salesmart.schema import POS_COLUMNS  # noqa: E402
from salesmart.session import local_session  # noqa: E402
from salesmart.sources import seeds  # noqa: E402
from salesmart.sources.warehouse import Warehouse  # noqa: E402

HEADLINE = [
    "stage_rows",
    "row_hash",
    "cast_matrix",
    "surrogate_keys",
    "dedupe_in_batch",
    "dedupe_vs_fact",
    "validate_rows",
    "validation_summary",
    "fact_load",
    "fact_load_idempotent",
    "gate_violations",
    "mart_daily_store",
    "mart_weekly_product",
    "mart_region_month",
    "top_payment_method",
    "drill_across",
    "rejection_rate",
    "reject_reasons_by_file",
    "run_counts",
    "sla_report",
    "stream_load",
    "stream_hourly_sales",
]


DAY = dt.date(2025, 1, 5)


def write_files(root: str, sales: int = 260) -> None:
    """One day's files: twelve stores, one of them in UTF-16."""
    os.makedirs(f"{root}/{DAY}")
    for store, *_ in seeds.STORES:
        encoding = seeds.ENCODINGS.get(store, "utf-8")
        with open(f"{root}/{DAY}/{store}_sales_{DAY}.csv", "w", newline="", encoding=encoding) as file:
            writer = csv.DictWriter(file, POS_COLUMNS)
            writer.writeheader()
            for n in range(sales):
                row = dict.fromkeys(POS_COLUMNS, "x") | {
                    "transaction_id": f"{store}-{n:05d}", "store_id": store, "transaction_date": f"{DAY} 10:{n % 60:02d}:00",
                    "product_sku": seeds.PRODUCTS[n % len(seeds.PRODUCTS)][0], "quantity": "1", "unit_price": "3.50",
                    "discount_applied": "0.00", "payment_method": seeds.PAYMENT_METHODS[n % len(seeds.PAYMENT_METHODS)], "cashier_id": f"{store}_C01",
                }
                writer.writerow(row)


def run_day(spark) -> float:
    """Seconds of one daily run into an empty warehouse."""
    place = tempfile.mkdtemp(prefix="salesmart-bench-")
    write_files(f"{place}/raw")
    house = Warehouse(spark, f"{place}/warehouse").create()
    house.write_dims(Dims(seeds.stores(spark, "Cafe"), seeds.products(spark), seeds.payments(spark), calendar.build(spark)))
    settings = daily.Settings(f"file:{place}/raw", seeds.ENCODINGS, archive=f"file:{place}/archive")
    start = time.perf_counter()
    done = daily.run_day(house, settings, DAY)
    seconds = time.perf_counter() - start
    if done["rows_loaded"] != 12 * 260:
        raise RuntimeError(f"the daily run loaded {done}")
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    setup = {}
    for name in ("staged", "loaded_before", "dims", "validated", "fact"):
        start = time.perf_counter()
        getattr(fixtures, name)(spark, sf_dir)
        setup[name] = round(time.perf_counter() - start, 3)
    seconds = {"run_day": round(run_day(spark), 3)} if not sys.argv[1:] else {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()) + sum(setup.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "setup": setup,
        "with_setup": round(time.perf_counter() - began, 3),
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
