"""Joins whose strategy follows a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.storage import Scratch

BROADCAST_ROWS = 250_000
#: Keys that are broadcast as 64-bit hashes, to tell which rows can have a match at all.
HASHED_KEYS = 1_000_000
#: More keys set bits of so many for each, up to so many keys, in words of 64 bits up to so many.
FILTER_BITS, FILTER_KEYS, FILTER_WORDS = 16, 32_000_000, 1 << 22
HOT_KEYS = 10_000
HOT_ROWS = 100_000


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Size check before a broadcast; on a written table the count comes from the file footers."""
    return table.count() <= max_rows


def hashes_of(rows: DataFrame, key: str) -> DataFrame:
    """The distinct 64-bit hashes of a key, as ``_hash``."""
    return rows.select(F.xxhash64(key).alias("_hash")).distinct()


def can_match(hashes: DataFrame, rows: int, key: str, hashed_keys: int = HASHED_KEYS) -> tuple[DataFrame, Column] | None:
    """A table to broadcast and the condition on which rows whose key's hash is one of ``hashes`` (``rows`` of them) join it.

    Up to ``hashed_keys`` hashes are the table themselves. Of more, each sets three bits of one word, so that some few
    other rows join, too; beyond ``FILTER_KEYS`` (or with no ``hashed_keys``) there is no such table.
    """
    if rows <= hashed_keys:
        return F.broadcast(hashes), F.xxhash64(F.col(key)) == F.col("_hash")
    if not hashed_keys or rows > FILTER_KEYS:
        return None
    words = min(1 << (rows * FILTER_BITS // 64).bit_length(), FILTER_WORDS)

    def place(hashed: Column) -> tuple[Column, Column]:
        bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, at).bitwiseAND(63).cast("int"))
        return F.shiftrightunsigned(hashed, 18).bitwiseAND(words - 1), bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))

    word, bits = place(F.col("_hash"))
    table = hashes.groupBy(word.alias("_word")).agg(F.bit_or(bits).alias("_bits"))
    word, bits = place(F.xxhash64(F.col(key)))
    return F.broadcast(table), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bits) == bits)


def attach(
    left: DataFrame,
    right: DataFrame,
    key: str,
    weight: str,
    row_id: str,
    scratch: Scratch,
    *,
    left_rows: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    hot_keys: int = HOT_KEYS,
    hot_rows: int = HOT_ROWS,
    heavy: DataFrame | None = None,
    hashed_keys: int | None = None,
) -> DataFrame:
    """Left join with at most one ``right`` row per key, safe when one key holds much of ``left``.

    ``right`` carries ``weight``, the number of left rows of its key, so it has no more rows than
    ``left``. When ``left_rows``, or else a count of ``right`` once written, is within ``max_rows``,
    ``right`` is broadcast and ``left`` is not shuffled at all. Otherwise only those of ``left`` that can have a match by their
    key's hash (``can_match``; ``hashed_keys`` is by default ``HASHED_KEYS``, none where ``left_rows`` are known to be few) are shuffled. In what is shuffled, the heaviest keys (a fixed
    number) are broadcast, and their left rows get a key of their own in the shuffle join of the rest,
    so they spread over all tasks; no right row is left out. ``heavy`` (key, weight) counts the keys of
    ``left`` where ``right`` lacks some of them: a key without a right row can be as hot. NULL keys match
    nothing and are spread, too.
    """
    payload = [name for name in right.columns if name not in (key, weight)]
    small = left_rows is not None and left_rows <= max_rows
    if not small:
        right = scratch.table(right, f"by-{key}")
        rows = right.count()
        small = rows <= max_rows
    if small:
        return left.join(F.broadcast(right.drop(weight)), key, "left")
    apart = None
    if hashed_keys is None:
        hashed_keys = HASHED_KEYS if left_rows is None or left_rows > BROADCAST_ROWS else 0
    told = can_match(hashes_of(right, key), rows, key, hashed_keys)
    if told:
        kinds = {f.name: f.dataType for f in right.schema}
        apart = left.join(*told, "left_anti").withColumns({name: F.lit(None).cast(kinds[name]) for name in payload})
        left = left.join(*told, "left_semi")

    counted = right if heavy is None else heavy.join(*told, "left_semi") if told else heavy
    hottest = counted.where(F.col(weight) >= hot_rows).orderBy(F.desc(weight), key).limit(hot_keys).select(key)
    found = right.select(key, *[F.col(name).alias(f"_hot_{name}") for name in payload])
    hot = hottest.join(found, key, "left").withColumn("_hot", F.lit(True))
    alone = F.col("_hot") | F.col(key).isNull()
    spread = F.when(alone, F.concat(F.lit("\u0000"), F.col(row_id).cast("string"))).otherwise(F.col(key))
    rest = right.select(F.col(key).alias("_key"), *payload)
    joined = (
        left.join(F.broadcast(hot), key, "left")
        .withColumn("_key", spread)
        .join(rest, "_key", "left")
        .withColumns({name: F.coalesce(f"_hot_{name}", name) for name in payload})
        .select(*left.columns, *payload)
    )
    return joined if apart is None else joined.unionByName(apart.select(*joined.columns))
