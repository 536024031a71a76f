"""Every operator as a named query over the driver tables."""

from __future__ import annotations


import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart import fixtures as fx, schema
from salesmart.functions.casts import date_key, to_decimal, to_smallint, to_ts
from salesmart.functions.hashing import row_hash
from salesmart.functions.measures import with_measures
from salesmart.operators import dims as dim_ops, gates, load, staging, validate
from salesmart.operators.ids import assign_ids
from salesmart.plans import marts, quality, runlog
from salesmart.plans.daily import Settings, backfill_range, clear, validate_and_load
from salesmart.schema import POS_COLUMNS, RUN_ENDED, RUN_STARTED
from salesmart.sources import landing
from salesmart.sources.warehouse import Warehouse
from salesmart.storage import Scratch
from salesmart.streaming import ingest, rolling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
FACT_COLUMNS = load.FACT_INPUT


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


# staging


@query
def stage_normalize(spark, sf):
    """One column of every row is blanked first, so each column sees empty text."""
    rows = fx.pos_rows(spark, sf)
    blanked = {
        name: F.when(F.col("stg_id") % 11 == i, F.lit("")).otherwise(F.col(name)) for i, name in enumerate(POS_COLUMNS)
    }
    return staging.normalize_empty(rows.withColumns(blanked)).select("stg_id", *POS_COLUMNS)


@query
def stage_rows(spark, sf):
    return staging.stage(fx.pos_rows(spark, sf), fx.load_time())


@query
def row_hash_(spark, sf):
    return fx.pos_rows(spark, sf).select("stg_id", row_hash().alias("row_hash"))


QUERIES["row_hash"] = QUERIES.pop("row_hash_")


@query
def surrogate_keys(spark, sf):
    rows = fx.staged(spark, sf).select("stg_id", "source_file")
    return assign_ids(rows, "row_key", Scratch(spark, "ids"), ["source_file", "stg_id"], start=1001).select("stg_id", "row_key")


@query
def cast_matrix(spark, sf):
    n = F.col("stg_id") % 12

    def variants(column: str, changes: dict[int, F.Column]):
        text = F.col(column)
        chosen = F.lit(None).cast("string")
        for which, change in reversed(changes.items()):
            chosen = F.when(n == which, change).otherwise(chosen)
        return F.when(n.isin(list(changes)), chosen).otherwise(text)

    qty, price, time = F.col("quantity"), F.col("unit_price"), F.col("transaction_date")
    texts = fx.staged(spark, sf).select(
        "stg_id",
        variants(
            "quantity",
            {
                0: F.concat(qty, F.lit(".0")),
                1: F.concat(F.lit("+"), qty),
                2: F.concat(F.lit(" "), qty, F.lit(" ")),
                3: F.concat(qty, F.lit("e3")),
                4: F.concat(qty, F.lit("0000")),
                5: F.lit(""),
                6: F.lit("   "),
            },
        ).alias("quantity"),
        variants(
            "unit_price",
            {
                0: F.concat(F.lit(" "), price, F.lit(" ")),
                1: F.concat(F.lit("$"), price),
                2: F.concat(price, F.lit("6")),
                3: F.concat(price, F.lit("e2")),
                4: F.concat(F.lit("9999999"), price),
                5: F.lit("-0.001"),
                6: F.lit(".5"),
                7: F.lit("1,000"),
                8: F.lit("3."),
            },
        ).alias("unit_price"),
        "discount_applied",
        variants(
            "transaction_date",
            {
                0: F.substring(time, 1, 10),
                1: F.replace(time, F.lit(" "), F.lit("T")),
                2: F.substring(time, 12, 30),
                3: F.substring(time, 1, 4),
                4: F.concat(time, F.lit(".123456")),
                5: F.lit("2025-02-30 00:00:00"),
                6: F.concat(F.lit(" "), time),
                7: F.substring(time, 1, 16),
            },
        ).alias("transaction_date"),
    )
    moment = F.col("_moment")
    return texts.withColumn("_moment", to_ts(F.col("transaction_date"))).select(
        "stg_id",
        to_smallint(qty).alias("quantity"),
        to_decimal(price).alias("unit_price"),
        to_decimal(F.col("discount_applied")).alias("discount_applied"),
        moment.alias("transaction_ts"),
        date_key(moment).alias("date_key"),
    )


@query
def staging_retention(spark, sf):
    """Validated rows spread over fifteen days of load times, cleared at the last of them."""
    age = F.make_interval(days=(F.col("stg_id") % 15).cast("int"))
    aged = fx.validated(spark, sf).withColumn("load_timestamp", fx.load_time() - age)
    return staging.retain(aged, fx.load_time()).select("stg_id", "validation_status", "rejection_reason", "load_timestamp")


# files


def _arrived(spark, sf):
    files = fx.staged(spark, sf).groupBy("source_file").agg(F.count("*").alias("file_rows"))
    store, day = landing.parse_file_name(F.col("source_file"))
    return files.select("source_file", store.alias("store_id"), day.alias("business_date"), "file_rows")


def _missing(spark, sf):
    expected = landing.expected_files(fx.dims(spark, sf).store, fx.FIRST_DAY, fx.LAST_DAY)
    return landing.missing_files(expected, _arrived(spark, sf))


@query
def file_name_parse(spark, sf):
    return _arrived(spark, sf)


@query
def expected_files(spark, sf):
    return landing.expected_files(fx.dims(spark, sf).store, fx.FIRST_DAY, fx.LAST_DAY)


@query
def missing_files(spark, sf):
    return quality.missing_history(runlog.log_missing(_missing(spark, sf), 1, fx.load_time(), scratch=Scratch(spark, "missing")))


# dimensions


@query
def dim_store(spark, sf):
    return fx.dims(spark, sf).store


@query
def dim_refresh(spark, sf):
    """The stored stores refreshed: some cities changed, the last store gone, one new."""
    stored = fx.dims(spark, sf).store
    changed = F.when(F.col("store_key") % 5 == 0, F.concat(F.upper("city"), F.lit(" NEW"))).otherwise(F.col("city"))
    source = stored.where("store_key < 25").withColumn("city", changed).drop("store_key", "created_at", "updated_at")
    fresh = {"store_id": "S26", "store_name": "Store 26", "city": "NEWTOWN"}
    new = stored.where("store_key = 1").withColumns({name: F.lit(value) for name, value in fresh.items()}).select(*source.columns)
    now = F.lit("2026-02-01 00:00:00").cast("timestamp_ntz")
    refreshed = dim_ops.build_store(source.unionByName(new), stored, now, Scratch(spark, "refresh"))
    return refreshed.select("store_key", "store_id", "store_name", "city", "is_active", "created_at", "updated_at")


@query
def dim_product(spark, sf):
    return fx.dims(spark, sf).product


@query
def dim_payment(spark, sf):
    return fx.dims(spark, sf).payment


@query
def dim_date(spark, sf):
    """The calendar with the number of fact rows of each day."""
    per_day = fx.fact(spark, sf).groupBy("date_key").agg(F.count("*").alias("fact_rows"))
    days = fx.dims(spark, sf).date.join(per_day, "date_key", "left")
    return days.withColumn("fact_rows", F.coalesce("fact_rows", F.lit(0)))


@query
def dim_row_counts(spark, sf):
    return dim_ops.row_counts(fx.dims(spark, sf))


@query
def dim_contracts(spark, sf):
    return dim_ops.contract_violations(fx.dims(spark, sf))


# validation


@query
def dedupe_in_batch(spark, sf):
    rows = fx.staged(spark, sf).select("stg_id", "transaction_id", "row_hash")
    return validate.mark_batch_dups(rows, Scratch(spark, "dups")).drop("row_hash")


@query
def dedupe_vs_fact(spark, sf):
    rows = fx.staged(spark, sf).select("stg_id", "transaction_id")
    return validate.mark_loaded(rows, fx.loaded_before(spark, sf), Scratch(spark, "loaded"))


@query
def validate_rows(spark, sf):
    return validate.run(fx.staged(spark, sf), fx.loaded_before(spark, sf), fx.dims(spark, sf), Scratch(spark, "validate"))


@query
def validation_summary(spark, sf):
    return validate.summary(fx.validated(spark, sf))


# load


def _load(spark, sf):
    rows, _ = load.run(fx.validated(spark, sf), fx.loaded_before(spark, sf), fx.dims(spark, sf), Scratch(spark, "load"))
    return rows


@query
def fact_load(spark, sf):
    return load.to_fact(_load(spark, sf), loaded_at=fx.load_time()).select(*FACT_COLUMNS)


@query
def fact_load_idempotent(spark, sf):
    """The same staged rows offered again after the first load: every loaded id is now a duplicate."""
    scratch = Scratch(spark, "again")
    dims, staged = fx.dims(spark, sf), fx.staged(spark, sf)
    known = fx.loaded_before(spark, sf)
    report = None
    for attempt in ("first", "second"):
        checked = scratch.table(validate.run(staged, known, dims, scratch), "validated")
        loaded, _ = load.run(checked, known, dims, scratch)
        loaded = scratch.table(loaded, "loaded")
        rejected = checked.agg(F.count_if(F.col("validation_status") == schema.FAIL).alias("rows_rejected"))
        lines = rejected.unionByName(loaded.agg(F.count("*").alias("rows_loaded")), allowMissingColumns=True)
        lines = lines.withColumn("attempt", F.lit(attempt))
        report = lines if report is None else report.unionByName(lines)
        known = known.unionByName(loaded.select("transaction_id"))
    return report.groupBy("attempt").agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected"))


@query
def load_metrics(spark, sf):
    return load.metrics(fx.validated(spark, sf), fx.fact(spark, sf))


@query
def fact_measures(spark, sf):
    return with_measures(fx.fact(spark, sf)).select("transaction_id", "gross_revenue", "discount_amount", "net_revenue")


def _risky(spark, sf):
    """Loadable rows with dates outside the calendar, lost discounts, and one id shared by a third of all rows."""
    rows = load.new_rows(fx.validated(spark, sf), fx.loaded_before(spark, sf), fx.dims(spark, sf), Scratch(spark, "gates"))
    every = lambda n: F.col("stg_id") % n == 0
    return rows.withColumns(
        {
            "date_key": F.when(every(211), F.lit(19990101)).otherwise(F.col("date_key")),
            "discount_applied": F.when(~every(223), F.col("discount_applied")),
            "transaction_id": F.when(every(3), F.lit("SHARED")).otherwise(F.col("transaction_id")),
        }
    )


@query
def gate_violations(spark, sf):
    return gates.violations(_risky(spark, sf), fx.dims(spark, sf))


@query
def gate_quarantine(spark, sf):
    _, held = gates.quarantine(_risky(spark, sf), fx.dims(spark, sf), Scratch(spark, "gates"))
    return held.select("stg_id", "rejection_reason")


# marts


@query
def mart_daily_store(spark, sf):
    return marts.daily_store(fx.fact(spark, sf), fx.dims(spark, sf))


@query
def mart_weekly_product(spark, sf):
    return marts.weekly_product(fx.fact(spark, sf), fx.dims(spark, sf))


@query
def mart_weekly_product_iso(spark, sf):
    return marts.weekly_product(fx.fact(spark, sf), fx.dims(spark, sf), iso_year=True)


@query
def mart_region_month(spark, sf):
    return marts.region_month(fx.fact(spark, sf), fx.dims(spark, sf))


@query
def top_payment_method(spark, sf):
    return marts.top_payment_method(fx.fact(spark, sf), fx.dims(spark, sf))


@query
def top_store_days(spark, sf):
    return marts.top_store_days(mart_daily_store(spark, sf))


@query
def top_product_weeks(spark, sf):
    return marts.top_product_weeks(mart_weekly_product(spark, sf))


@query
def region_report(spark, sf):
    return marts.region_report(mart_region_month(spark, sf))


@query
def drill_across(spark, sf):
    """Sales beside orders, both summed per day and store."""
    sales = (
        with_measures(fx.fact(spark, sf))
        .groupBy("date_key", "store_key")
        .agg(F.count("*").alias("sale_count"), F.sum("net_revenue").cast(schema.MONEY).alias("sale_net"))
    )
    day = F.date_add(F.lit(fx.FIRST_DAY).cast("date"), (F.col("o_orderkey") % 731).cast("int"))
    orders = (
        fx.read(spark, sf, "orders")
        .select(
            date_key(day).alias("date_key"),
            (F.col("o_custkey") % 12 + 1).cast("int").alias("store_key"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        )
        .groupBy("date_key", "store_key")
        .agg(F.count("*").alias("order_count"), F.sum("total").cast(schema.GROSS).alias("order_total"))
    )
    return marts.drill_across(sales, orders)


# quality and run log


@query
def rejection_rate(spark, sf):
    return quality.rejection_rate(fx.validated(spark, sf))


@query
def reject_reasons(spark, sf):
    return quality.reasons(fx.validated(spark, sf))


@query
def reject_codes(spark, sf):
    return quality.reasons(fx.validated(spark, sf), by_code=True)


@query
def reject_reasons_by_file(spark, sf):
    return quality.reasons_by_file(fx.validated(spark, sf))


@query
def dup_by_file(spark, sf):
    return quality.dup_by_file(fx.validated(spark, sf))


@query
def freshness(spark, sf):
    return quality.freshness(fx.fact(spark, sf))


@query
def run_counts(spark, sf):
    return runlog.counts(fx.validated(spark, sf), fx.fact(spark, sf))


def _events(spark, sf):
    """A start and an end event per business date; some runs never end and some fail."""
    _, day = landing.parse_file_name(F.col("source_file"))
    per_day = (
        fx.by_file(spark, sf)
        .groupBy(day.alias("run_date"))
        .agg(
            F.count("*").cast("smallint").alias("files_processed"),
            F.sum("total_rows").alias("rows_staged"),
            F.sum("passed").alias("rows_passed"),
            F.sum("failed").alias("rows_rejected"),
            F.sum("passed").alias("rows_loaded"),
            F.sum("duplicates").alias("rows_duplicates"),
        )
        .withColumn("run_id", F.date_diff("run_date", F.lit(fx.FIRST_DAY).cast("date")).cast("long") + 1)
    )
    began = F.col("run_date").cast("timestamp_ntz") + F.make_interval(hours=F.lit(30))
    seconds = F.make_interval(secs=(F.col("rows_staged") * 37 % 4000).cast("decimal(18,6)"))
    failed = F.col("run_id") % 53 == 0
    text = lambda value: F.lit(value).cast("string")
    started = F.struct(
        text(RUN_STARTED).alias("event"),
        began.alias("event_at"),
        text(schema.RUNNING).alias("status"),
        F.lit(12).cast("smallint").alias("files_expected"),
        text(None).alias("error_message"),
    )
    ended = F.struct(
        text(RUN_ENDED).alias("event"),
        (began + seconds).alias("event_at"),
        F.when(failed, schema.FAILED).otherwise(schema.SUCCESS).alias("status"),
        F.lit(None).cast("smallint").alias("files_expected"),
        F.when(failed, F.lit("load failed")).alias("error_message"),
    )
    both = F.when(F.col("run_id") % 97 == 0, F.array(started)).otherwise(F.array(started, ended))
    return (
        per_day.withColumn("_event", F.explode(both))
        .select("*", "_event.*", text(None).alias("notes"))
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.RUN_EVENTS])
    )


def _runs(spark, sf):
    days = F.date_diff("business_date", F.lit(fx.FIRST_DAY).cast("date")).cast("long") + 1
    missing = _missing(spark, sf).withColumn("run_id", days)
    return runlog.fold(_events(spark, sf), missing)


@query
def run_log(spark, sf):
    return _runs(spark, sf).drop("notes")


@query
def run_summary(spark, sf):
    return runlog.summary(_runs(spark, sf))


@query
def stuck_runs(spark, sf):
    now = F.lit("2025-06-01 01:00:00").cast("timestamp_ntz")
    return quality.stuck_runs(_runs(spark, sf), now).select("run_id", "run_date", "pipeline_start", "status")


@query
def sla_report(spark, sf):
    return quality.sla_report(_runs(spark, sf), fx.by_file(spark, sf))


# warehouse


def _stream_house(spark, sf, place):
    """An empty warehouse that knows the dimensions and the ids of an earlier load."""
    warehouse = Warehouse(spark, f"{place.path}/warehouse").create()
    warehouse.write_dims(fx.dims(spark, sf))
    warehouse.write_ids(fx.loaded_before(spark, sf), "run-0")
    return warehouse


@query
def fact_load_two_writers(spark, sf):
    """All staged rows offered by two writers at once: every sale is loaded by one of them."""
    place = Scratch(spark, "writers")
    warehouse = _stream_house(spark, sf, place)
    rows = fx.staged(spark, sf)

    def load_all(name):
        own = Warehouse(spark, warehouse.root)
        return validate_and_load(own, rows, name, Scratch(spark, name), Settings(raw=""))

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load_all, ["run-1", "run-2"]))
    return warehouse.fact().select(*FACT_COLUMNS)


@query
def clear_staging(spark, sf):
    """Rejects of fifteen days of load times in a warehouse, cleared at the last of them: what is left in its table."""
    place = Scratch(spark, "clear")
    warehouse = _stream_house(spark, sf, place)
    age = F.make_interval(days=(F.col("stg_id") % 15).cast("int"))
    rows = place.table(fx.staged(spark, sf).withColumn("load_timestamp", fx.load_time() - age), "aged")
    validate_and_load(warehouse, rows, "run-1", place, Settings(raw=""))
    clear(warehouse, Settings(raw=""), "run-1", dt.datetime.fromisoformat(fx.LOAD_TIME))
    return warehouse.read("rejects").select("stg_id", "validation_status", "rejection_reason", "load_timestamp")


_houses: dict[tuple[str, str], Warehouse] = {}


def _filled_house(spark, sf):
    """A warehouse that has loaded all store files of nine dates in one pass; built once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _houses:
        warehouse = Warehouse(spark, f"{Scratch(spark, 'range').path}/warehouse").create()
        warehouse.write_dims(fx.dims(spark, sf))
        settings = Settings(raw=fx.store_files(spark, sf), encodings={"S09": "UTF-16"}, retention_days=None)
        backfill_range(warehouse, settings, fx.FILE_START, fx.FILE_START + dt.timedelta(days=fx.FILE_DAYS - 1))
        _houses[key] = warehouse
    return _houses[key]


@query
def backfill_range_(spark, sf):
    """Nine business dates loaded in one pass; resent rows come a date later."""
    return _filled_house(spark, sf).fact().select(*FACT_COLUMNS)


QUERIES["backfill_range"] = QUERIES.pop("backfill_range_")


@query
def backfill_rejects(spark, sf):
    """Rejects of the same, by file and reason."""
    return _filled_house(spark, sf).read("rejects").groupBy("source_file", "rejection_reason").agg(F.count("*").alias("rejected_rows"))


@query
def backfill_runs(spark, sf):
    """The run log of the same."""
    house = _filled_house(spark, sf)
    runs = runlog.summary(runlog.fold(house.read("run_events"), house.read("missing_files")), fx.FILE_DAYS)
    return runs.drop("duration_seconds", "error_message")


@query
def stream_files_load(spark, sf):
    """The same files as a stream: encodings by store, columns by each file's own header. Which of two copies comes first is
    up to the batches, so the file's name is left out."""
    place = Scratch(spark, "stream-files")
    warehouse = Warehouse(spark, f"{place.path}/warehouse").create()
    warehouse.write_dims(fx.dims(spark, sf))
    rows = ingest.stream_files(spark, fx.store_files(spark, sf), files_per_batch=60)
    ingest.start_load(rows, warehouse, f"{place.path}/checkpoint", Settings(raw="", encodings={"S09": "UTF-16"})).awaitTermination()
    return warehouse.fact().select(*[name for name in FACT_COLUMNS if name != "source_file"])


# streaming


@query
def stream_load(spark, sf):
    """The staged rows as a file stream, loaded in two micro-batches into an empty warehouse."""
    source = fx.staged(spark, sf)
    place = Scratch(spark, "stream")
    warehouse = _stream_house(spark, sf, place)
    per_batch = -(-len(source.inputFiles()) // 2)
    rows = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", per_batch).parquet(fx.staged_path(spark, sf))
    ingest.start_load(rows, warehouse, f"{place.path}/checkpoint", Settings(raw=""), staged=True).awaitTermination()
    return warehouse.fact().select(*FACT_COLUMNS)


@query
def stream_load_mixed(spark, sf):
    """A daily slice of some staged files, then two streams over all of them, the second a replay of the first."""
    source = fx.staged(spark, sf)
    place = Scratch(spark, "mixed")
    warehouse = _stream_house(spark, sf, place)
    files = sorted(source.inputFiles())
    some = spark.read.schema(source.schema).parquet(*files[: max(1, len(files) // 3)])
    validate_and_load(warehouse, some, "run-1", place, Settings(raw=""))
    for name, batches in (("first", 2), ("second", 1)):
        rows = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", -(-len(files) // batches)).parquet(fx.staged_path(spark, sf))
        ingest.start_load(rows, warehouse, f"{place.path}/{name}", Settings(raw=""), staged=True, name=name).awaitTermination()
    return warehouse.fact().select(*FACT_COLUMNS)


@query
def stream_hourly_sales(spark, sf):
    place = Scratch(spark, "hourly")
    path = f"{sf}/events.parquet"
    kinds = spark.read.parquet(path).schema
    # a stream takes a folder or a pattern, and the table may be one file
    events = spark.readStream.schema(kinds).parquet(f"{sf}/{{events.parquet}}").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    totals = rolling.hourly(events, "ts", "event_type", "value")
    rolling.start_hourly(totals, f"{place.path}/totals", f"{place.path}/checkpoint").awaitTermination()
    return rolling.latest(spark, f"{place.path}/totals", ["hour_start", "event_type"], ["sales", "value_sum"])


@query
def stream_hourly_late(spark, sf):
    """Events in two files, every seventh in the second only: totals of what came in time, and what came too late."""
    place = Scratch(spark, "late")
    events = fx.read(spark, sf, "events").select(F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    delayed = F.col("event_id") % 7 == 0
    source = f"{place.path}/events"
    for part in (~delayed, delayed):
        events.where(part).coalesce(1).write.mode("append").parquet(source)
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rolling.start_totals(rows, f"{place.path}/totals", f"{place.path}/checkpoint", "ts", "event_type", "value").awaitTermination()
    return rolling.totals(spark, f"{place.path}/totals", "event_type")
