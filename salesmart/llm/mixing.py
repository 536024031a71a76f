"""Mixing sources to target weights with hash thresholds.

Every document has a fixed 60-bit hash. A source takes its documents a whole number of times, and those
below a hash threshold once more. The threshold comes from nested histograms: word counts by source and
by the leading bits of the hash show in which bucket the budget runs out, and only the rows of that
bucket are counted again by the bits that follow. Nothing is sorted, and a hot source is counted
map-side first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.operators.lookups import is_small
from salesmart.storage import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
HASH_BITS = 60
LEVEL_BITS = 10


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with each source's ``target``.

    The budget is ``share`` times all sizes. Sources share it by weight; a target stops at ``most``
    times its source's size and the excess is shared anew, which ends at one water level: in order of
    size / weight, the first sources are full and the others get their weight's part of the rest.
    One row per source passes through the single-task windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ratio = F.col("source_size") / F.col("_weight")
    fill = Window.orderBy("_ratio", "_number").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("_number"), F.lit(len(weights))) + 1).cast("int"))
    numbered = (
        sizes.withColumn("_number", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight)
        .withColumn("_ratio", ratio)
    )
    levels = numbered.select(
        "*",
        F.coalesce(F.sum("source_size").over(fill), F.lit(0)).alias("_full"),
        (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(fill), F.lit(0))).alias("_open"),
        F.sum("source_size").over(whole).alias("_all"),
    )
    # what a source gets when all before it are full and it shares the rest with those after it
    part = F.col("_weight") * (F.col("_all") * F.lit(float(share)) - F.col("_full") * F.lit(int(most))) / F.col("_open")
    capped = part >= F.col("source_size") * F.lit(int(most))
    levels = levels.withColumn("_capped", capped).withColumn("_part", part)
    level = F.min(F.when(~F.col("_capped"), F.struct("_ratio", "_number", "_full", "_open"))).over(whole)
    rest = F.col("_weight") * (F.col("_all") * F.lit(float(share)) - level["_full"] * F.lit(int(most))) / level["_open"]
    target = F.when(F.col("_capped"), (F.col("source_size") * F.lit(int(most))).cast("double")).otherwise(rest)
    return levels.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, plan: DataFrame, scratch: Scratch) -> DataFrame:
    """For each source: ``copies`` of everything, and the last hash ``_upto`` that is taken once more.

    ``sized`` holds source_id, size and hash. A group of equal hashes stands or falls together; it is
    taken when that brings the source nearer to its target.
    """
    plan = plan.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    rest = F.col("target") - F.col("copies") * F.col("source_size")
    edge = plan.select("*", rest.alias("_rest"), F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_before"))
    for level in range(HASH_BITS // LEVEL_BITS):
        edge = scratch.table(edge, f"edge{level}")
        below = HASH_BITS - LEVEL_BITS * (level + 1)
        narrow = edge.select("source_id", "_prefix")
        narrow = F.broadcast(narrow) if is_small(edge) else narrow
        bucket = F.shiftright("hash", below)
        inside = sized.join(narrow, "source_id").where(F.shiftright(bucket, LEVEL_BITS) == F.col("_prefix"))
        counts = inside.groupBy("source_id", bucket.alias("_bucket")).agg(F.sum("size").alias("_words"))
        counts = counts.join(edge.select("source_id", "_rest", "_before"), "source_id")
        upto = Window.partitionBy("source_id").orderBy("_bucket")  # at most 1,024 buckets of each source
        counts = counts.withColumn("_after", F.col("_before") + F.sum("_words").over(upto))
        # the first bucket in which the budget runs out, or else the last one
        found = counts.groupBy("source_id").agg(
            F.coalesce(
                F.min(F.when(F.col("_after") > F.col("_rest"), F.struct("_bucket", "_after", "_words"))),
                F.max(F.struct("_bucket", "_after", "_words")),
            ).alias("_edge")
        )
        edge = edge.drop("_prefix", "_before", "_group").join(found, "source_id").select(
            *[name for name in edge.columns if name not in ("_prefix", "_before", "_group")],
            F.col("_edge._bucket").alias("_prefix"),
            (F.col("_edge._after") - F.col("_edge._words")).alias("_before"),
            F.col("_edge._words").alias("_group"),
        )
    over = F.col("_before") + F.col("_group") - F.col("_rest")
    takes_group = (F.col("_before") < F.col("_rest")) & (over <= F.col("_rest") - F.col("_before"))
    return scratch.table(
        edge.select("source_id", "source_size", "target", "copies", F.when(takes_group, F.col("_prefix")).otherwise(F.col("_prefix") - 1).alias("_upto")),
        "thresholds",
    )


def _hash() -> Column:
    """The first 60 bits of the MD5 of id and text."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _source_id() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the hash."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select("doc_id", "source", size.alias("size"), _hash().alias("hash"))


def _fitted(slim: DataFrame, scratch: Scratch, weights, share: float, most: int) -> DataFrame:
    """Targets and thresholds of every source of written, sized rows."""
    sizes = scratch.table(slim.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    plan = scratch.table(targets(sizes, weights, share, most).withColumn("source_id", _source_id()).drop("source"), "targets")
    edge = thresholds(slim.withColumn("source_id", _source_id()), plan, scratch)
    return F.broadcast(edge) if is_small(edge) else edge


def _copies(most: int) -> Column:
    copies = F.col("copies") + F.when(F.col("hash") <= F.col("_upto"), 1).otherwise(0)
    return F.least(copies.cast("long"), F.lit(int(most)).cast("long"))


def mix(documents: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken (words), copies and hash for every row of ``documents``.

    Reads doc_id, source and text only. A null text has size 0; a null source is a source of its own,
    the last one; rows that repeat id and text are taken together; an empty table gives no rows. A
    source without words has target 0.
    """
    slim = scratch.table(sized(documents), "sized")
    edge = _fitted(slim, scratch, weights, share, most)
    copies = _copies(most)
    return slim.withColumn("source_id", _source_id()).join(edge, "source_id").select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "hash"
    )


def mixed_documents(documents: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: rows of ``documents`` with all their columns, each as often as it is taken."""
    edge = _fitted(scratch.table(sized(documents), "sized"), scratch, weights, share, most)
    whole = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_document")
    rows = documents.select(whole, _source_id().alias("source_id"), _hash().alias("hash")).join(edge, "source_id")
    rows = rows.select("_document", _copies(most).alias("_taken")).where("_taken > 0")
    return rows.select("_document", F.explode(F.array_repeat(F.lit(1), F.col("_taken").cast("int")))).select("_document.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3, 1, 2][(number % 3 + 1)::INT]::BIGINT AS weight FROM sizes
), levels AS (
  SELECT *, source_size / weight AS ratio,
         coalesce(sum(source_size) OVER fill, 0)::DOUBLE AS full_size,
         (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0))::DOUBLE AS open_weight,
         (sum(source_size) OVER ())::DOUBLE AS all_size
  FROM weighted
  WINDOW fill AS (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, weight * (all_size * 1.5::DOUBLE - full_size * 2) / open_weight >= source_size * 2 AS is_capped FROM levels
), water AS (
  SELECT full_size AS w_full, open_weight AS w_open FROM capped WHERE NOT is_capped ORDER BY ratio, number LIMIT 1
), plan AS (
  SELECT source, source_size, CASE WHEN is_capped THEN (source_size * 2)::DOUBLE
         ELSE weight * (all_size * 1.5::DOUBLE - w_full * 2) / w_open END AS target
  FROM capped LEFT JOIN water ON true
), ranked AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, d.hash,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size)::BIGINT ELSE 0 END AS whole,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash))::BIGINT AS after,
         (sum(d.size) OVER (PARTITION BY d.source, d.hash))::BIGINT AS grp
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
), decided AS (
  SELECT *, target - whole * source_size AS rest, after - grp AS before FROM ranked
)
SELECT doc_id, size, source_size, target,
       least(whole + CASE WHEN after <= rest OR (before < rest AND after - rest <= rest - before) THEN 1 ELSE 0 END, 2) * size AS taken,
       least(whole + CASE WHEN after <= rest OR (before < rest AND after - rest <= rest - before) THEN 1 ELSE 0 END, 2) AS copies, hash
FROM decided
"""
