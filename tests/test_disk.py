"""What stays on disk on the way: shuffle files, copies of staged rows, and rows that are moved without need."""

from __future__ import annotations

import os
import time

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from rows import ids, staged

from salesmart import fixtures as fx, storage
from salesmart.functions.hashing import row_hash
from salesmart.operators import gates, load, lookups, validate
from salesmart.plans import catalog
from salesmart.sources.warehouse import Warehouse
from salesmart.storage import Scratch


def shuffle_files(spark) -> dict[str, int]:
    """Shuffle files and their bytes."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    paths = [os.path.join(at, name) for folder in folders for at, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")]
    return {path: os.stat(path).st_size for path in paths if os.path.exists(path)}


def left_by(spark, run, bound: int = 0) -> int:
    """Bytes of shuffle files that ``run`` leaves behind; Spark deletes them beside the work that goes on."""
    before = shuffle_files(spark)
    run()
    for _ in range(50):
        left = sum(size for path, size in shuffle_files(spark).items() if path not in before)
        if left <= bound:
            break
        time.sleep(0.1)
    return left


@pytest.fixture
def written(monkeypatch):
    """Names of the tables written by any Scratch, with the columns of their files."""
    seen = []
    table = Scratch.table

    def noted(self, df, name, derive=None, **options):
        seen.append((name, set(df.columns) - set(derive or {})))
        return table(self, df, name, derive, **options) if derive else table(self, df, name, **options)

    monkeypatch.setattr(Scratch, "table", noted)
    return seen


def fresh(monkeypatch):
    """As in a new session: nothing is written yet."""
    monkeypatch.setattr(fx, "_tables", {})
    monkeypatch.setattr(fx, "_folders", {})
    monkeypatch.setattr(fx, "_dims", {})
    monkeypatch.setattr(catalog, "_houses", {})


def test_a_written_table_leaves_no_shuffle_files(spark, scratch):
    rows = spark.range(10_000).withColumn("k", F.col("id") % 100)
    both = rows.join(rows.groupBy("k").agg(F.count("*").alias("n")), "k").repartition(3, "id")
    assert not left_by(spark, lambda: scratch.table(both, "both"))
    assert spark.conf.get(storage._CLEANUP) == "false"


def test_the_cleanup_setting_is_put_back_when_the_last_one_leaves(spark):
    with storage.dropping_shuffles(spark):
        with pytest.raises(ValueError), storage.dropping_shuffles(spark):
            raise ValueError
        assert spark.conf.get(storage._CLEANUP) == "true"
    assert spark.conf.get(storage._CLEANUP) == "false" and not storage._cleaning


def test_a_checked_batch_leaves_no_shuffle_files(spark, scratch, dims):
    rows = staged(spark, scratch, *[{}] * 20)
    checked = scratch.table(validate.run(rows, ids(spark, "T3"), dims, scratch), "checked")
    pending = scratch.table(load.new_rows(checked, None, dims, scratch).repartition(3), "pending")
    assert not left_by(spark, lambda: gates.enforce(pending, dims))


def test_more_findings_than_hashes_still_move_few_rows(spark, scratch):
    """Above the limit of hashes, bits tell which rows can match: every match is found, and few other rows are shuffled."""
    rows = scratch.table(spark.range(50_000).select(F.col("id").alias("stg_id"), F.concat(F.lit("T"), "id").alias("k")), "rows")
    found = rows.where("stg_id % 25 = 0").select("k", F.lit(1).alias("n"), (F.col("stg_id") + 1).alias("found"))
    marked = lookups.attach(rows, found, "k", "n", "stg_id", scratch, max_rows=0, hashed_keys=100)
    assert "LeftSemi" in marked._jdf.queryExecution().optimizedPlan().toString()
    assert marked.count() == 50_000 == marked.where((F.col("stg_id") % 25 == 0).eqNullSafe(F.col("found") == F.col("stg_id") + 1) | F.col("found").isNull()).count()
    assert marked.where("found is not null").count() == 2_000
    told = lookups.can_match(lookups.hashes_of(found, "k"), 2_000, "k", 100)
    assert 2_000 <= rows.join(*told, "left_semi").count() < 2_000 + 50_000 * 0.03
    assert lookups.can_match(found, lookups.FILTER_KEYS + 1, "k", 100) is None


def test_stored_verdicts_leave_out_the_hash(spark, monkeypatch, written):
    """The hash follows from three columns beside it; who asks for it gets the staged one."""
    fresh(monkeypatch)
    checked = fx.validated(spark, SMALL)
    assert [columns for name, columns in written if name == "validated"] == [set(checked.columns) - {"row_hash"}]
    pairs = fx.staged(spark, SMALL).select("stg_id", "row_hash").exceptAll(checked.select("stg_id", "row_hash"))
    assert pairs.isEmpty() and checked.count() == fx.staged(spark, SMALL).count()


BUILT = ["fact_measures", "mart_region_month", "mart_weekly_product", "top_product_weeks", "top_store_days", "fact_load", "rejection_rate", "dup_by_file", "reject_codes"]


@pytest.mark.parametrize("name", BUILT)
def test_building_a_query_leaves_its_tables_only(spark, monkeypatch, name):
    """What a query over a new folder shuffles on the way goes (but for some row counts), and its tables have all rows."""
    fresh(monkeypatch)
    frames = []
    assert left_by(spark, lambda: frames.append(catalog.QUERIES[name](spark, SMALL)), 10_000) <= 10_000
    assert frames[0].count() > 0 and fx.validated(spark, SMALL).count() == fx.staged(spark, SMALL).count()


def test_lines_are_joined_one_table_at_a_time(spark, monkeypatch, written):
    """Each join's result is written, so what one join shuffles is gone before the next; the first result goes once the second is there."""
    fresh(monkeypatch)
    lines = fx.numbered_lines(spark, SMALL)
    names = [name for name, _ in written]
    assert names[:2] == ["lines", "described"]
    want = fx.read(spark, SMALL, "lineitem").join(fx.read(spark, SMALL, "part"), F.col("l_partkey") == F.col("p_partkey"))
    assert lines.select("l_orderkey", "l_linenumber", "p_name").exceptAll(want.select("l_orderkey", "l_linenumber", "p_name")).isEmpty()
    assert lines.agg(F.count_distinct("seq"), F.min("seq"), F.max("seq")).first() == (want.count(), 1, want.count())


def test_facts_of_a_range_are_written_beside_the_judged_rows_only(spark, monkeypatch):
    """When the fact rows of all dates are written, what judging them took is gone, and the run log counts every row."""
    fresh(monkeypatch)
    beside = []
    write = Warehouse.write_attempt

    def noted(self, df, table, attempt, load_id=None):
        root = storage.shared_root(spark).removeprefix("file:") + "/salesmart"
        runs = [os.path.join(root, name) for name in os.listdir(root) if name.startswith("runs-")]
        beside.extend((table, name.split("-")[0]) for run in runs for name in os.listdir(run))
        return write(self, df, table, attempt, load_id)

    monkeypatch.setattr(Warehouse, "write_attempt", noted)
    runs = catalog.QUERIES["backfill_runs"](spark, SMALL)
    assert {name for table, name in beside if table == "fact_sales"} == {"judged", "splits"}
    assert runs.agg(F.sum("rows_staged")).first()[0] == fx.pos_rows(spark, SMALL).count()


def test_backfilled_rows_are_held_once_on_the_way(spark, monkeypatch, written):
    """Staged rows are read where they were landed, and what is judged leaves out the hash that follows from other columns."""
    fresh(monkeypatch)
    rejects = catalog.QUERIES["backfill_rejects"](spark, SMALL)
    names = [name for name, _ in written]
    assert "staged" not in names and "rows" not in names
    assert all("row_hash" not in columns for name, columns in written if name in ("alone", "validated"))
    assert rejects.agg(F.sum("rejected_rows")).first()[0] > 0
    kept = next(iter(catalog._houses.values())).read("rejects")
    assert kept.count() == kept.where(F.col("row_hash") == row_hash()).count() > 0
