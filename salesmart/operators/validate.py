"""Validation: duplicates first, then seven ordered rules; the first that fails is the reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.casts import date_key, is_blank, to_decimal, to_smallint, to_ts
from salesmart.operators.dims import Dims, lookup
from salesmart.operators.lookups import BROADCAST_ROWS, HASHED_KEYS, attach, can_match
from salesmart.schema import DUPLICATE, FAIL, PASS, REASONS
from salesmart.sources.id_index import IdIndex
from salesmart.storage import DENSE, Scratch

KEYS = ["store_key", "product_key", "payment_key"]


@dataclass(frozen=True)
class Options:
    """``null_fk``: 'pass' keeps rows whose store, sku or payment is NULL (they resolve to no key later),
    'reject' fails them. ``dedupe``: 'before_rules' lets an invalid first copy shadow a valid second one,
    'after_rules' looks for duplicates among valid rows only. ``collation`` is for natural-key lookups."""

    null_fk: str = "pass"
    dedupe: str = "before_rules"
    collation: str | None = None


def reason(code: str, value: str | None = None) -> Column:
    text = F.lit(REASONS[code])
    return text if value is None else F.concat(text, F.coalesce(F.col(value), F.lit("NULL")))


def rules(options: Options = Options()) -> Column:
    """Reason of the first failing rule, or NULL. Expects the key columns of ``dims.lookup``."""

    def unknown(natural: str, key: str) -> Column:
        missing = F.col(key).isNull()
        return missing if options.null_fk == "reject" else F.col(natural).isNotNull() & missing

    price = F.coalesce(to_decimal(F.col("unit_price")), F.lit(-1))
    return F.coalesce(
        F.when(is_blank(F.col("transaction_id")), reason("V01")),
        F.when(unknown("store_id", "store_key"), reason("V02", "store_id")),
        F.when(to_ts(F.col("transaction_date")).isNull(), reason("V03", "transaction_date")),
        F.when(unknown("product_sku", "product_key"), reason("V04", "product_sku")),
        F.when(price < 0, reason("V05", "unit_price")),
        F.when(to_smallint(F.col("quantity")).isNull(), reason("V06", "quantity")),
        F.when(unknown("payment_method", "payment_key"), reason("V07", "payment_method")),
    )


def loaded_ids(batch: DataFrame, fact_ids: DataFrame | IdIndex, row_count: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Those of a batch's ids, with their counts, that the fact already holds.

    A batch of at most ``max_rows`` rows is broadcast to the ids. A larger one is joined on the id; where these are
    bucketed by id, only the batch moves. An index reads the parts of its tables that the batch can meet.
    """
    if isinstance(fact_ids, IdIndex):
        return fact_ids.holding(batch, row_count, max_rows)
    if row_count <= max_rows:
        matches = fact_ids.select("transaction_id").join(F.broadcast(batch), "transaction_id")
        return matches.dropDuplicates(["transaction_id"])
    return batch.join(fact_ids.select("transaction_id"), "transaction_id", "left_semi")


def mark_loaded(
    rows: DataFrame,
    fact_ids: DataFrame,
    scratch: Scratch,
    source: DataFrame | None = None,
    row_count: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    **limits: int,
) -> DataFrame:
    """Add ``is_loaded``: the transaction id is in the fact.

    ``source`` is the table the ids of ``rows`` come from, when ``rows`` itself is a longer plan. Only ids
    travel, and the batch is counted per id first.
    """
    source = rows if source is None else source
    row_count = source.count() if row_count is None else row_count
    batch = source.where("transaction_id is not null").groupBy("transaction_id").agg(F.count("*").alias("_rows"))
    found = loaded_ids(batch, fact_ids, row_count, max_rows).withColumn("_found", F.lit(True))
    limits |= {"left_rows": row_count, "max_rows": max_rows}
    marked = attach(rows, found, "transaction_id", "_rows", "stg_id", scratch, heavy=batch, **limits)
    return marked.withColumn("is_loaded", F.coalesce("_found", F.lit(False))).drop("_found")


def mark_batch_dups(
    rows: DataFrame, scratch: Scratch, eligible: Column | None = None, row_count: int | None = None, key: str = "row_hash", **limits: int
) -> DataFrame:
    """Add ``is_batch_dup``: another row of the batch has the same hash and a lower stg_id.

    Counted per hash with map-side partial sums; only hashes seen twice or more are joined back. In a batch of more than
    ``max_rows`` rows these are first narrowed down by 64-bit numbers, so that few of the long texts travel.
    """
    pool = rows if eligible is None else rows.where(eligible)
    row_count = rows.count() if row_count is None else row_count
    if row_count > limits.get("max_rows", BROADCAST_ROWS):
        shared = pool.groupBy(F.xxhash64(key).alias("_hash")).agg(F.count("*").alias("_rows")).where("_rows > 1").select("_hash")
        shared = scratch.table(shared, f"shared-{key}")
        told = can_match(shared, shared.count(), key, limits.get("hashed_keys", HASHED_KEYS))
        pool = pool.join(*told, "left_semi") if told else pool
    groups = (
        pool.groupBy(key)
        .agg(F.min("stg_id").alias("_keep"), F.count("*").alias("_copies"))
        .where("_copies > 1")
    )
    marked = attach(rows, groups, key, "_copies", "stg_id", scratch, left_rows=row_count, **limits)
    return marked.withColumn("is_batch_dup", F.coalesce(F.col("stg_id") > F.col("_keep"), F.lit(False))).drop("_keep")


def run(
    staged: DataFrame,
    fact_ids: DataFrame | IdIndex,
    dims: Dims,
    scratch: Scratch,
    options: Options = Options(),
    key: str = "row_hash",
    **limits: int,
) -> DataFrame:
    """Staged rows with status, reason and resolved keys. ``staged`` should be a written table; rows of one ``key`` are copies."""
    limits.setdefault("row_count", staged.count())
    after_rules = options.dedupe == "after_rules"
    rows = staged.drop("validation_status", "rejection_reason")
    if after_rules:
        rows = lookup(rows, dims, options.collation).withColumn("_rule", rules(options))
        rows = mark_batch_dups(rows, scratch, F.col("_rule").isNull(), key=key, **limits)
        rows = mark_loaded(rows, fact_ids, scratch, staged, **limits)
    else:
        rows = mark_batch_dups(rows, scratch, key=key, **limits)
        rows = mark_loaded(rows, fact_ids, scratch, staged, **limits)
        rows = lookup(rows, dims, options.collation).withColumn("_rule", rules(options))
    duplicate = F.when(F.col("is_loaded") | F.col("is_batch_dup"), F.lit(DUPLICATE))
    verdict = F.coalesce("_rule", duplicate) if after_rules else F.coalesce(duplicate, "_rule")
    return _with_status(rows, verdict).select(*staged.columns, *KEYS)


def _with_status(rows: DataFrame, verdict: Column) -> DataFrame:
    return rows.withColumn("rejection_reason", verdict).withColumn(
        "validation_status", F.when(F.col("rejection_reason").isNull(), PASS).otherwise(FAIL)
    )


def run_days(
    staged: DataFrame,
    fact_ids: DataFrame | IdIndex,
    dims: Dims,
    scratch: Scratch,
    options: Options = Options(),
    derive: dict[str, Callable[[], Column]] | None = None,
    **limits: int,
) -> DataFrame:
    """Rows of several dates (``_day``) at once, judged as if each date had been loaded before the next was validated.

    A date's rows are first judged by themselves. An id is then loaded on the first date with a row of it that passes, resolves its
    keys and breaks no gate; its rows of later dates are duplicates. That needs no more than one minimum per id, since a
    row's fitness on its own date depends on no other date while its id is not loaded. ``derive``: see ``Scratch.table``.
    """
    whole = staged.withColumn("_day_hash", F.concat(F.col("_day").cast("string"), F.lit(":"), "row_hash"))
    alone = scratch.table(run(whole, fact_ids, dims, scratch, options, "_day_hash", **limits).drop("_day_hash"), "alone", derive, **DENSE)
    moment = to_ts(F.col("transaction_date"))
    known = dims.date.select(F.col("date_key").alias("_key"), F.lit(True).alias("_in_calendar"))
    rows = alone.withColumn("_key", date_key(moment)).join(F.broadcast(known), "_key", "left").drop("_key")
    typed = [to_smallint(F.col("quantity")), to_decimal(F.col("unit_price")), to_decimal(F.col("discount_applied"))]
    good = (F.col("validation_status") == PASS) & F.col("_in_calendar")
    for value in [*typed, *map(F.col, KEYS), F.col("transaction_id")]:
        good &= value.isNotNull()
    firsts = (
        rows.groupBy("transaction_id")
        .agg(F.min(F.when(good, F.col("_day"))).alias("_first_day"), F.max("_day").alias("_last_day"), F.count("*").alias("_rows"))
        .where("_first_day < _last_day")
        .drop("_last_day")
    )
    limits |= {"left_rows": limits.pop("row_count", None)}
    marked = attach(rows.drop("_in_calendar"), firsts, "transaction_id", "_rows", "stg_id", scratch, **limits)
    later = F.when(F.col("_day") > F.col("_first_day"), F.lit(DUPLICATE))
    ruled = F.when(F.col("rejection_reason") != DUPLICATE, F.col("rejection_reason"))
    verdict = F.coalesce(ruled, later, "rejection_reason") if options.dedupe == "after_rules" else F.coalesce(later, "rejection_reason")
    return _with_status(marked, verdict).select(*alone.columns)


def summary(validated: DataFrame) -> DataFrame:
    return validated.groupBy("validation_status").agg(F.count("*").alias("row_count"))
