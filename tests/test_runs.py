"""Store files, the daily run and streams, on files written by the tests."""

from __future__ import annotations

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rows import BASE
from salesmart.plans import daily, marts, quality, runlog
from salesmart.schema import POS_COLUMNS
from salesmart.sources import landing, seeds
from salesmart.storage import Scratch
from salesmart.streaming import ingest, rolling

DAY = dt.date(2025, 1, 5)


def write(root, store: str, rows: list[dict], date=DAY, encoding="utf-8", columns=POS_COLUMNS):
    folder = root / str(date)
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / f"{store}_sales_{date}.csv", "w", newline="", encoding=encoding) as f:
        writer = csv.DictWriter(f, columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)


def sale(store: str, number: int, date=DAY, **changes) -> dict:
    row = {k: v for k, v in BASE.items() if k in POS_COLUMNS}
    return row | {"transaction_id": f"{store}-{date:%Y%m%d}-{number:05d}", "store_id": store, "transaction_date": f"{date} 10:{number % 60:02d}:00"} | changes


def write_day(root, date=DAY, skip=("S07",)):
    """Twelve stores of five sales: one bad price in S03, one resent row in S11, S09 in UTF-16."""
    for store, *_ in seeds.STORES:
        if store in skip:
            continue
        rows = [sale(store, n, date) for n in range(5)]
        if store == "S03":
            rows[2]["unit_price"] = "3.8X"
        if store == "S11":
            rows.append(dict(rows[1]))
        write(root, store, rows, date, "utf-16" if store == "S09" else "utf-8")


def collected(df):
    return sorted(map(tuple, df.select("source_file", *POS_COLUMNS).collect()), key=str)


def test_reader_handles_quotes_line_breaks_and_blanks(spark, tmp_path):
    rows = [
        sale("S01", 1, product_name='Say "hi", twice', category="two\nlines"),
        sale("S01", 2, cashier_id="", category=" "),
    ]
    write(tmp_path, "S01", rows)
    path = str(tmp_path / str(DAY) / f"S01_sales_{DAY}.csv")
    with open(path, "a", newline="") as f:
        f.write("\r\n")
    got = landing.read_pos_csv(spark, [f"file:{path}"]).orderBy("file_row").collect()
    assert [(r.product_name, r.category) for r in got] == [('Say "hi", twice', "two\nlines"), ("Flat White", " ")]
    assert got[1].cashier_id in (None, "")


def test_reader_binds_by_header_name(spark, tmp_path):
    """Reordered, missing and extra columns, in files read together."""
    write(tmp_path, "S01", [sale("S01", 1)])
    write(tmp_path, "S02", [sale("S02", 1)], columns=list(reversed(POS_COLUMNS)))
    write(tmp_path, "S03", [sale("S03", 1)], columns=[c for c in POS_COLUMNS if c != "cashier_id"])
    write(tmp_path, "S04", [sale("S04", 1) | {"extra": "x"}], columns=["extra", *POS_COLUMNS])
    got = {r.store_id: r for r in landing.read_landing(spark, f"file:{tmp_path}", DAY).collect()}
    for store in ("S01", "S02", "S03", "S04"):
        want = sale(store, 1) | ({"cashier_id": None} if store == "S03" else {})
        assert {c: got[store][c] for c in POS_COLUMNS} == want
        assert got[store].source_file == f"{store}_sales_{DAY}.csv"


def test_utf16_store_reads_like_the_others(spark, tmp_path):
    rows = [sale("S09", n, product_name="Café crème") for n in range(30)]
    write(tmp_path, "S09", rows, encoding="utf-16")
    got = landing.read_landing(spark, f"file:{tmp_path}", DAY, seeds.ENCODINGS).orderBy("file_row")
    assert [r.transaction_id for r in got.collect()] == [r["transaction_id"] for r in rows]
    assert got.where("product_name = 'Café crème' and cashier_id = 'S01_C01'").count() == 30


def test_a_feed_declared_without_line_breaks_is_split(spark, tmp_path):
    write(tmp_path, "S01", [sale("S01", n, product_name='a "b", c') for n in range(400)])
    root = f"file:{tmp_path}"
    want = collected(landing.read_landing(spark, root, DAY))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert collected(landing.read_landing(spark, root, DAY)) == want
        split = landing.read_landing(spark, root, DAY, line_breaks=False)
        assert collected(split) == want and len(want) == 400
        assert split.select("file_block").distinct().count() > 1
        order = [r.transaction_id for r in split.orderBy("file_block", "file_row").collect()]
        assert order == sorted(order)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_reader_has_no_caps(spark, tmp_path):
    """Over a hundred columns, a repeated name (the last counts), a long header and odd folder names."""
    root = tmp_path / "raw six #1^é"
    extra = [f"extra_{i}_{'x' * 900}" for i in range(100)]
    write(root, "S01", [sale("S01", 1)], columns=[*extra, *POS_COLUMNS])
    path = root / str(DAY) / f"S02_sales_{DAY}.csv"
    path.write_text(",".join([*POS_COLUMNS, "quantity"]) + "\n" + ",".join([*sale("S02", 1).values(), "9"]) + "\n")
    below = root / str(DAY) / "copy"
    below.mkdir()
    (below / f"S01_sales_{DAY}.csv").write_text(path.read_text())
    got = {r.store_id: r for r in landing.read_landing(spark, f"file:{root}", DAY).collect()}
    assert set(got) == {"S01", "S02"}
    assert {c: got["S01"][c] for c in POS_COLUMNS} == sale("S01", 1) and got["S02"].quantity == "9"


def test_lone_carriage_returns_and_blank_lines_do_not_depend_on_block_size(spark, tmp_path):
    write(tmp_path, "S01", [sale("S01", n, product_name="a\rb" if n == 2 else "plain") for n in range(5)])
    with open(tmp_path / str(DAY) / f"S01_sales_{DAY}.csv", "a", newline="") as f:
        f.write("   \r\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = collected(landing.read_landing(spark, f"file:{tmp_path}", DAY))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert collected(landing.read_landing(spark, f"file:{tmp_path}", DAY)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [row[5] for row in want if row[1] and row[1].endswith("00002")] == ["a\rb"]


def test_headers_need_no_job_unless_they_need_the_parser(spark, tmp_path):
    from salesmart.sources.files import Files

    cases = {"plain": "a,b ,c\r\n1,2,3\n", "no end": "a,b", "long": ",".join(f"name_{i}" for i in range(3000)) + "\nx"}
    parsed = {"quoted": 'a,"b"\n1', "blank": "\na,b\n", "mac": "a,b\r1,2\r", "empty": ""}
    for encoding in ("utf-8", "utf-16", "utf-8-sig"):
        for name, text in (cases | parsed).items():
            path = tmp_path / f"{name}.csv"
            path.write_bytes(text.encode(encoding))
            got = landing.plain_header(Files(spark), f"file:{path}", encoding)
            assert got == (None if name in parsed else text.splitlines()[0].split(","))
            if got and encoding != "utf-8-sig":
                assert landing.read_header(spark, f"file:{path}", encoding) == got
    assert landing.plain_header(Files(spark), f"file:{path}", "no-such-encoding") is None


def test_arrivals_and_missing_files(spark, tmp_path, dims):
    write(tmp_path, "S01", [sale("S01", 1)])
    (tmp_path / str(DAY) / "notes.txt").write_text("x")
    arrivals = landing.list_arrivals(spark, f"file:{tmp_path}", DAY)
    assert [(r.store_id, r.business_date) for r in arrivals.collect()] == [("S01", DAY)]
    missing = landing.missing_files(landing.expected_files(dims.store, DAY), arrivals)
    assert missing.count() == 11 and missing.where("expected_file = 'S12_sales_2025-01-05.csv'").count() == 1
    closed = dims.store.withColumn("is_active", F.col("store_id") == "S01")
    assert landing.missing_files(landing.expected_files(closed, DAY), arrivals).count() == 0


def test_daily_run_end_to_end(spark, warehouse, tmp_path):
    raw = tmp_path / "raw"
    write_day(raw)
    settings = daily.Settings(f"file:{raw}", seeds.ENCODINGS)
    first = daily.run_day(warehouse, settings, DAY)
    assert first == {
        "files_processed": 11, "rows_staged": 56, "rows_passed": 54, "rows_rejected": 2, "rows_duplicates": 1, "rows_loaded": 54, "run_id": 1,
        "remaining_rejected_rows": 2,
    }
    assert warehouse.read("staging").count() == 0
    rejects = {r.rejection_reason for r in warehouse.read("rejects").collect()}
    assert rejects == {"DUPLICATE", "V05: unit_price is not a valid positive decimal - 3.8X"}
    # the resent row is the one after the original
    assert warehouse.read("rejects").where("rejection_reason = 'DUPLICATE'").first().transaction_id == "S11-20250105-00001"
    # redoing a run replaces its slices
    before = sorted(map(tuple, warehouse.fact().drop("loaded_at").collect()))
    assert daily.run_day(warehouse, settings, DAY, run_id=1) == first
    assert sorted(map(tuple, warehouse.fact().drop("loaded_at").collect())) == before
    assert warehouse.read("rejects").count() == 2 and warehouse.read("missing_files").count() == 1
    # a new run over the same files loads nothing
    again = daily.run_day(warehouse, settings, DAY)
    assert (again["rows_loaded"], again["rows_duplicates"], again["run_id"]) == (0, 55, 2)

    next_day = DAY + dt.timedelta(days=1)
    write_day(raw, next_day, skip=())
    assert [done["rows_loaded"] for done in daily.backfill(warehouse, settings, next_day, next_day)] == [59]
    fact = warehouse.fact()
    assert fact.count() == 54 + 59
    assert fact.select("sales_key").distinct().count() == 113
    by_day = fact.groupBy("date_key").agg(F.min("sales_key"), F.max("sales_key")).orderBy("date_key").collect()
    assert by_day[0][2] < by_day[1][1]

    runs = runlog.fold(warehouse.read("run_events"), warehouse.read("missing_files"))
    report = [(r.run_id, r.status, r.files_expected, r.files_processed, r.files_missing, r.rows_loaded) for r in runlog.summary(runs).collect()]
    assert report == [(3, "SUCCESS", 12, 12, None, 59), (2, "SUCCESS", 12, 11, 1, 0), (1, "SUCCESS", 12, 11, 1, 54)]
    history = [(r.run_date, r.store_id) for r in quality.missing_history(warehouse.read("missing_files")).collect()]
    assert history == [(DAY, "S07")] * 2
    assert marts.daily_store(fact, warehouse.dims()).count() == 23
    assert daily.clear(warehouse, settings) == warehouse.read("rejects").count() > 0
    assert daily.clear(warehouse, settings, now=dt.datetime(2040, 1, 1)) == 0 == warehouse.read("rejects").count()
    archived = daily.Settings(f"file:{raw}", seeds.ENCODINGS, archive=f"file:{tmp_path}/archive")
    daily.run_day(warehouse, archived, next_day)
    assert not list((raw / str(next_day)).glob("*.csv")) and len(list((tmp_path / "archive" / str(next_day)).glob("*.csv"))) == 12


def test_a_large_batch_moves_no_loaded_id(spark, warehouse):
    """Merged id tables are bucketed: beyond the broadcast bound only the batch is exchanged."""
    from salesmart.operators import validate

    warehouse.fan, warehouse.ids_per_bucket = 2, 1000
    warehouse.write_ids(spark.range(2000).select(F.concat(F.lit("T"), "id").alias("transaction_id")), "run-1")
    warehouse.write_ids(spark.range(2000, 3000).select(F.concat(F.lit("T"), "id").alias("transaction_id")), "run-2")
    batch = spark.range(1900, 4000).select(F.concat(F.lit("T"), "id").alias("transaction_id")).groupBy("transaction_id").agg(F.count("*").alias("_rows"))
    found = validate.loaded_ids(batch, warehouse.known_ids(but="run-9"), 10**6, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "loaded_ids" in line)
    depth, above = len(lines[at]), []  # the scan's ancestors, up to the join
    for line in reversed(lines[: at + 1]):
        indent = len(line) - len(line.lstrip(" :+-*("))
        if indent < depth:
            depth = indent
            above.append(line)
        if "Join" in line:
            break
    assert "Bucketed: true" in plan and "Join" in above[-1]
    assert not any("Exchange" in line for line in above)
    assert found.count() == 1100
    assert validate.loaded_ids(batch, warehouse.known_ids(but="run-2"), 10**6, 0).count() == 100


def test_absent_hot_ids_are_spread(spark, scratch):
    """Four fifths of the rows share one blank id that was never loaded, and some ids are NULL."""
    from salesmart.operators import validate

    share = F.when(F.col("id") % 5 > 0, F.lit("  ")).when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.concat(F.lit("T"), "id"))
    rows = scratch.table(spark.range(20_000).select(F.col("id").alias("stg_id"), share.alias("transaction_id")), "rows")
    ids = spark.createDataFrame([("T5",), ("T10",)], "transaction_id string")
    for key, value in {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(key, value)
    try:
        marked = validate.mark_loaded(rows, ids, scratch, row_count=20_000, max_rows=0, hot_rows=10, hot_keys=5)
        sizes = [row["count"] for row in marked.groupBy(F.spark_partition_id()).count().collect()]
        assert marked.where("is_loaded").count() == 2 and marked.count() == 20_000
        assert max(sizes) < 2 * 20_000 / 16
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_a_load_reads_no_fact_rows(spark, warehouse, tmp_path):
    """Sales keys come from markers and loaded ids from one column; a redone load keeps its keys."""
    assert [warehouse.reserve_keys(name, 10) for name in ("a-0", "b-0", "a-0")] == [1, 11, 1]
    assert warehouse.reserve_keys("c-0", 5) == 21
    warehouse.files.create(warehouse.path(f"markers/keys/{26:020d}"), "")  # its writer died
    assert warehouse.reserve_keys("d-0", 5) == 26 + 10**12 + 1
    write(tmp_path / "raw", "S01", [sale("S01", 1)])
    daily.run_day(warehouse, daily.Settings(f"file:{tmp_path}/raw"), DAY)
    plan = warehouse.fact_ids()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<transaction_id:string>" in plan


def test_two_runs_at_once_get_their_own_ids(spark, warehouse):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: warehouse.new_run_id(), range(16)))
    assert sorted(ids) == list(range(1, 17))


def test_quarantine_counts_every_staged_row(spark, warehouse, tmp_path):
    """One good row, one overlong, one held by a gate: staged = passed + rejected."""
    raw = tmp_path / "raw"
    write(raw, "S01", [sale("S01", 1), sale("S01", 2, quantity="1" * 11), sale("S01", 3, discount_applied="abc")])
    done = daily.run_day(warehouse, daily.Settings(f"file:{raw}", on_violation="quarantine"), DAY)
    assert [done[name] for name in ("rows_staged", "rows_passed", "rows_rejected", "rows_loaded")] == [3, 1, 2, 1]


def test_stream_checks_lengths_like_the_daily_run(spark, warehouse, tmp_path):
    write(tmp_path / "raw", "S01", [sale("S01", 1), sale("S01", 2, cashier_id="c" * 500)])
    rows = ingest.stream_pos_csv(spark, f"file:{tmp_path}/raw")
    settings = daily.Settings(raw="", on_violation="quarantine")
    ingest.start_load(rows, warehouse, f"{tmp_path}/checkpoint", settings).awaitTermination()
    assert warehouse.fact().count() == 1 and warehouse.read("rejects").first().rejection_reason.startswith("LENGTH: cashier_id")


def test_one_stream_takes_all_encodings_after_a_daily_run(spark, warehouse, tmp_path):
    raw, settings = tmp_path / "raw", None
    write_day(raw)
    settings = daily.Settings(f"file:{raw}", seeds.ENCODINGS)
    daily.run_day(warehouse, settings, DAY)
    next_day = DAY + dt.timedelta(days=1)
    write_day(raw, next_day, skip=())
    stores = [store for store, *_ in seeds.STORES]
    rows = ingest.stream_stores(spark, f"file:{raw}", stores, seeds.ENCODINGS, files_per_batch=9)
    ingest.start_load(rows, warehouse, f"{tmp_path}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    assert warehouse.fact().count() == 54 + 59
    assert warehouse.fact().select("sales_key").distinct().count() == 54 + 59
    with pytest.raises(Exception, match="belongs to"):
        ingest.start_load(rows, warehouse, f"{tmp_path}/other")


def test_a_failed_refresh_leaves_the_old_dimensions(spark, warehouse):
    from salesmart.operators import dims as dim_ops

    old = warehouse.dims()
    counts = {name: df.count() for name, df in old.items()}
    source = old.store.where("store_id != 'S12'").withColumn("city", F.lit("Moved")).drop("store_key", "created_at", "updated_at")
    broken = dim_ops.Dims(old.store.unionByName(old.store.limit(1)), old.product, old.payment, old.date)
    with pytest.raises(dim_ops.DimensionContractError):
        warehouse.write_dims(broken)
    assert {name: df.count() for name, df in warehouse.dims().items()} == counts
    built = dim_ops.build_store(source, old.store)
    fresh = warehouse.write_dims(dim_ops.Dims(built, old.product, old.payment, old.date))
    assert {name: df.count() for name, df in fresh.items()} == counts
    rows = {r.store_id: r for r in fresh.store.collect()}
    before = {r.store_id: r for r in old.store.collect()}
    assert not rows["S12"].is_active and rows["S12"].city == before["S12"].city and rows["S01"].city == "Moved"
    assert all(rows[s].store_key == before[s].store_key and rows[s].created_at == before[s].created_at for s in before)


def test_failed_run_is_logged_and_loads_nothing(spark, warehouse, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "S01", [sale("S01", 1), sale("S01", 2, discount_applied="abc")])
    settings = daily.Settings(f"file:{raw}")
    with pytest.raises(daily.load.gates.GateViolation):
        daily.run_day(warehouse, settings, DAY)
    assert warehouse.fact().count() == 0
    runs = runlog.fold(warehouse.read("run_events"), warehouse.read("missing_files"))
    row = runs.first()
    assert row.status == "FAILED" and "not_null" in row.error_message and row.files_missing == 11
    held = daily.run_day(warehouse, daily.Settings(f"file:{raw}", on_violation="quarantine"), DAY)
    assert held["rows_loaded"] == 1
    assert warehouse.read("rejects").first().rejection_reason.startswith("GATE: a fact measure")


def test_overlong_rows_can_be_held_back(spark, warehouse, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "S01", [sale("S01", 1), sale("S01", 2, quantity="1" * 11)])
    done = daily.run_day(warehouse, daily.Settings(f"file:{raw}", on_violation="quarantine"), DAY)
    assert done["rows_loaded"] == 1
    assert warehouse.read("rejects").first().rejection_reason.startswith("LENGTH: quantity")


def test_no_files_fails_unless_allowed(spark, warehouse, tmp_path):
    settings = daily.Settings(f"file:{tmp_path}/none")
    with pytest.raises(landing.NoInputFiles):
        daily.run_day(warehouse, settings, DAY)
    done = daily.run_day(warehouse, daily.Settings(f"file:{tmp_path}/none", allow_empty=True), DAY)
    assert done["rows_loaded"] == 0 and done["run_id"] == 2
    assert warehouse.read("missing_files").count() == 24


def test_csv_stream_equals_the_daily_run(spark, dims, tmp_path):
    from salesmart.sources.warehouse import Warehouse

    raw = tmp_path / "raw"
    write_day(raw, skip=("S07", "S09"))
    batch = Warehouse(spark, f"{tmp_path}/batch").create()
    batch.write_dims(dims)
    daily.run_day(batch, daily.Settings(f"file:{raw}"), DAY)
    streamed = Warehouse(spark, f"{tmp_path}/stream").create()
    streamed.write_dims(dims)
    rows = ingest.stream_pos_csv(spark, f"file:{raw}", files_per_batch=5)
    ingest.start_load(rows, streamed, f"{tmp_path}/checkpoint").awaitTermination()
    columns = ["date_key", "store_key", "product_key", "payment_key", "transaction_id", "quantity", "unit_price", "source_file"]
    both = [sorted(map(tuple, w.fact().select(*columns).collect())) for w in (batch, streamed)]
    assert both[0] == both[1] and len(both[0]) == 49
    assert streamed.fact().select("sales_key").distinct().count() == 49


def test_stream_archives_and_skips_late_copies(spark, warehouse, tmp_path):
    raw, archive, checkpoint = tmp_path / "raw", tmp_path / "archive", f"{tmp_path}/checkpoint"

    def drain():
        rows = ingest.stream_pos_csv(spark, f"file:{raw}", archive=f"file:{archive}")
        ingest.start_load(rows, warehouse, checkpoint).awaitTermination()

    write(raw, "S01", [sale("S01", 1), sale("S01", 2)])
    drain()
    next_day = DAY + dt.timedelta(days=1)
    write(raw, "S01", [sale("S01", 2), sale("S01", 1, next_day)], next_day)
    drain()
    assert warehouse.fact().count() == 3
    assert warehouse.read("rejects").first().rejection_reason == "DUPLICATE"
    write(raw, "S02", [sale("S02", 1, next_day)], next_day)
    drain()
    archived = {name for _, _, names in os.walk(archive) for name in names if name.endswith(".csv")}
    assert f"S01_sales_{DAY}.csv" in archived


def test_stream_refuses_a_reordered_header(spark, warehouse, tmp_path):
    write(tmp_path / "raw", "S01", [sale("S01", 1)], columns=list(reversed(POS_COLUMNS)))
    rows = ingest.stream_pos_csv(spark, f"file:{tmp_path}/raw")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.start_load(rows, warehouse, f"{tmp_path}/checkpoint").awaitTermination()


def test_hourly_totals_over_several_batches(spark, tmp_path):
    moments = [dt.datetime(2025, 1, 5, 10, m) for m in (1, 2, 59)] + [dt.datetime(2025, 1, 5, 11, 0)]
    source = str(tmp_path / "events")
    for number, moment in enumerate(moments):
        spark.createDataFrame([(moment, "S01", 1.25)], "ts timestamp, store_id string, value double").coalesce(1).write.mode("append").parquet(source)
    kinds = spark.read.parquet(source).schema
    rows = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(source)
    totals = rolling.hourly(rows, "ts", "store_id", "value")
    rolling.start_hourly(totals, f"{tmp_path}/totals", f"{tmp_path}/checkpoint").awaitTermination()
    got = rolling.latest(spark, f"{tmp_path}/totals", ["hour_start", "store_id"], ["sales", "value_sum"])
    want = rolling.hourly(spark.read.parquet(source), "ts", "store_id", "value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 2


def test_scratch_drop_removes_only_its_own_tables(spark):
    kept, dropped = Scratch(spark, "kept"), Scratch(spark, "dropped")
    table = kept.table(spark.range(3), "t")
    dropped.table(spark.range(3), "t")
    dropped.drop()
    assert table.count() == 3
