"""Ids of loaded transactions: recent loads' own rows, and tables merged from them, bucketed and sorted by id.

Once ``FAN`` loads have gathered, their ids are merged into one table; once ``FAN`` tables of a level have, they are merged into one of
the next. So an id is rewritten once a level, and there are few tables whatever the number of loads. Each merged table has as
many buckets as its size asks for.

A check of a batch first narrows the tables to the ranges of ids that the batch holds. Within a table ids stand in order, so files
skip the pages outside of these ranges; a batch of few ids also reads its own buckets only.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.operators.lookups import BROADCAST_ROWS
from salesmart.sources.commits import IDS, CommitLog, State
from salesmart.storage import dropping_shuffles

FAN = 16
IDS_PER_BUCKET = 4_000_000
#: Ranges a batch is narrowed to, lengths of prefix that may tell them apart, and how many ids are named one by one.
ZONES, PREFIXES, FEW_IDS = 64, (1, 2, 3, 4, 6, 8, 10, 12, 16, 20, 24, 32), 500


@dataclass
class IdIndex:
    """The ids of one state of the log. ``sources``: frames with transaction_id; those of tables are bucketed and sorted by it."""

    spark: SparkSession
    sources: list[DataFrame]

    def ids(self) -> DataFrame:
        """All loaded ids."""
        if not self.sources:
            return self.spark.createDataFrame([], "transaction_id string")
        return reduce(DataFrame.union, self.sources)

    def holding(self, batch: DataFrame, row_count: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
        """Those of a batch's rows, one per id, whose id is loaded."""
        held = [self._held(batch, source, row_count, max_rows) for source in self._narrowed(batch)]
        if not held:
            return batch.limit(0)
        return reduce(DataFrame.union, held).dropDuplicates(["transaction_id"])

    def _narrowed(self, batch: DataFrame) -> list[DataFrame]:
        if not self.sources:
            return []
        ids = batch.select("transaction_id").where("transaction_id is not null")
        # ids often begin with what they have in common (a store, a day): a zone is a prefix, as long as there are not too many
        begin = lambda n: F.substring("transaction_id", 1, n)
        kinds = ids.agg(*[F.approx_count_distinct(begin(n)).alias(str(n)) for n in PREFIXES]).first()
        length = max((n for n in PREFIXES if kinds[str(n)] <= ZONES), default=0)
        spread = ids.groupBy(begin(length)) if length else ids.groupBy()
        bounds = F.min("transaction_id").alias("low"), F.max("transaction_id").alias("high"), F.count("*").alias("n")
        zones = [zone for zone in spread.agg(*bounds).collect() if zone.n]  # one row per prefix
        if not zones:
            return []
        if sum(zone.n for zone in zones) <= FEW_IDS:
            named = sorted({row.transaction_id for row in ids.collect()})
            # ten at a time, which files compare with their pages; more would be taken as one range
            tests = [F.col("transaction_id").isin(named[at : at + 10]) for at in range(0, len(named), 10)]
        else:
            tests = [F.col("transaction_id").between(zone.low, zone.high) for zone in zones]
        while len(tests) > 1:
            tests = [reduce(lambda a, b: a | b, tests[at : at + 2]) for at in range(0, len(tests), 2)]
        return [source.where(tests[0]) for source in self.sources]

    @staticmethod
    def _held(batch: DataFrame, source: DataFrame, row_count: int, max_rows: int) -> DataFrame:
        if row_count <= max_rows:
            return source.join(F.broadcast(batch), "transaction_id").select(*batch.columns)
        return batch.join(source, "transaction_id", "left_semi")


def table_of(spark: SparkSession, location: str, buckets: int) -> DataFrame:
    """A merged table; the session's catalog knows it by its place, its files stay when the session ends."""
    name = f"loaded_ids_{hashlib.sha256(location.encode()).hexdigest()[:40]}"
    quoted = location.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (transaction_id STRING, load_id STRING) USING parquet "
        f"CLUSTERED BY (transaction_id) SORTED BY (transaction_id) INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )
    return spark.table(name)


def write_table(spark: SparkSession, rows: DataFrame, location: str, buckets: int) -> None:
    name = f"loaded_ids_{hashlib.sha256(location.encode()).hexdigest()[:40]}"
    sized = rows.select("transaction_id", "load_id").repartition(buckets, "transaction_id")
    with dropping_shuffles(rows.sparkSession):
        sized.write.bucketBy(buckets, "transaction_id").sortBy("transaction_id").option("path", location).saveAsTable(name)


def valid_rows(spark: SparkSession, root: str, state: State, folder: str, but: str | None = None) -> DataFrame:
    """A table's ids that still count: loads that were committed again later have theirs elsewhere now."""
    table = state.tables[folder]
    rows = table_of(spark, f"{root}/{folder}", table["buckets"])
    void = [name for name, load in state.loads.items() if load["again"] and load["version"] > table["seen"]]
    void += [but] if but in state.loads else []
    return rows.where(~F.col("load_id").isin(void)) if void else rows


def uncovered(state: State, but: str | None = None) -> list[str]:
    """Loads whose ids no table holds yet."""
    return [name for name, load in state.loads.items() if not load["covered"] and name != but and load["rows"]]


def index(spark: SparkSession, root: str, state: State, recent, but: str | None = None) -> IdIndex:
    """The ids of a state, without those of load ``but``; ``recent(state, names)`` reads loads that no table covers."""
    sources = [valid_rows(spark, root, state, folder, but).select("transaction_id") for folder in sorted(state.tables)]
    names = uncovered(state, but)
    return IdIndex(spark, [*sources, recent(state, names).select("transaction_id")] if names else sources)


def merge_due(state: State, fan: int = FAN) -> tuple[list[str], list[str], int] | None:
    """(loads, tables, level) of the next merge, or None."""
    loads, fan = uncovered(state), max(fan, 2)
    if len(loads) >= fan:
        return loads, [], 1
    levels: dict[int, list[str]] = {}
    for folder, table in state.tables.items():
        levels.setdefault(table["level"], []).append(folder)
    full = [level for level, folders in levels.items() if len(folders) >= fan]
    return ([], sorted(levels[min(full)]), min(full) + 1) if full else None


def merge(spark: SparkSession, root: str, log: CommitLog, recent, fan: int = FAN, ids_per_bucket: int = IDS_PER_BUCKET) -> bool:
    """Merge the ids of enough loads, or tables of one level, into one table; False if none are due or another writer did it first."""
    state = log.state()
    due = merge_due(state, fan)
    if due is None:
        return False
    loads, tables, level = due
    size = sum(state.loads[name]["rows"] for name in loads) + sum(state.tables[folder]["rows"] for folder in tables)
    rows = recent(state, loads).select("transaction_id", "load_id") if loads else reduce(DataFrame.unionByName, [valid_rows(spark, root, state, f) for f in tables])
    folder, buckets = f"loaded_ids/level-{level}/{uuid.uuid4().hex}", max(1, -(-size // ids_per_bucket))
    write_table(spark, rows, f"{root}/{folder}", buckets)
    covers = {name: state.loads[name]["attempt"] for name in loads}
    entry = {"kind": IDS, "folder": folder, "buckets": buckets, "rows": size, "level": level, "seen": state.version, "drops": tables, "covers": covers}
    now = state
    while all(f in now.tables for f in tables) and all(now.loads[n]["attempt"] == a and not now.loads[n]["covered"] for n, a in covers.items()):
        if log.append(entry, now):
            return True
        now = log.state()
    log.files.delete(f"{root}/{folder}")
    return False
