"""Shards chosen by descending a weighted hash tree: region, then rack, then shard.

At every level each child draws a score from the row's key, its own path and its weight
(``-ln(u) / weight``); the smallest score wins. A child's weight is the sum of its shards' weights,
so a change of weight only moves rows into or out of the subtrees that hold the changed shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.operators.ids import assign_ids
from salesmart.storage import Scratch


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


def even_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> list[Shard]:
    """Shards 0 to regions * racks * shards - 1 of equal weight."""
    return [
        Shard(f"region{n // (racks * shards)}", f"rack{n // shards}", n) for n in range(regions * racks * shards)
    ]


def grow(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard in a region and rack of its own, so that rows only ever move into it."""
    number = max((shard.number for shard in tree), default=-1) + 1
    return [*tree, Shard(f"region-of-{number}", f"rack-of-{number}", number, weight)]


def _draw(key: Column, children: dict[str, float]) -> Column:
    """The child with the smallest score; equal scores go to the first name."""
    scores = []
    for path, weight in sorted(children.items()):
        unit = (F.shiftrightunsigned(F.xxhash64(F.lit(path), key), 11) + 0.5) / float(1 << 53)
        scores.append(F.struct((-F.log(unit) / F.lit(float(weight))).alias("score"), F.lit(path).alias("path")))
    return F.least(*scores)["path"] if len(scores) > 1 else F.lit(next(iter(children)))


def _per_child(chosen: Column, branches: dict[str, Column]) -> Column:
    result = F.lit(None)
    for path, column in branches.items():
        result = F.when(chosen == path, column).otherwise(result)
    return result


def with_shard(df: DataFrame, key: Column, tree: list[Shard], name: str) -> DataFrame:
    """Add column ``name`` with the shard of ``key`` (a null key counts as one more key value).

    Shards of weight 0 take no rows; a tree without any positive weight is an error.
    """
    live = [shard for shard in tree if shard.weight > 0]
    if not live:
        raise ValueError("the tree holds no shard of positive weight")
    regions: dict[str, float] = {}
    racks: dict[str, dict[str, float]] = {}
    shards: dict[str, dict[str, float]] = {}
    for shard in live:
        region, rack = shard.region, f"{shard.region}/{shard.rack}"
        regions[region] = regions.get(region, 0) + shard.weight
        racks.setdefault(region, {})
        racks[region][rack] = racks[region].get(rack, 0) + shard.weight
        shards.setdefault(rack, {})[f"{rack}/{shard.number}"] = shard.weight
    key = F.coalesce(key.cast("string"), F.lit("\u0000null"))
    return (
        df.withColumn("_region", _draw(key, regions))
        .withColumn("_rack", _per_child(F.col("_region"), {r: _draw(key, racks[r]) for r in regions}))
        .withColumn("_leaf", _per_child(F.col("_rack"), {r: _draw(key, shards[r]) for r in shards}))
        .withColumn(name, F.substring_index("_leaf", "/", -1).cast("int"))
        .drop("_region", "_rack", "_leaf")
    )


def place(documents: DataFrame, scratch: Scratch, tree: list[Shard] | None = None) -> DataFrame:
    """Shard and place in the shard for every row of ``documents``.

    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, do not take part. A null
    text is empty, rows of one ``doc_id`` share a shard, repeated rows get a place each, and an empty
    table gives no rows. ``grown_shard`` is the shard after one more has joined the tree. Places follow
    a range-partitioned order of (shard, doc_id, row), so no task holds a whole shard.
    """
    tree = tree or even_tree()
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = with_shard(rows, F.col("doc_id"), tree, "shard")
    rows = with_shard(rows, F.col("doc_id"), grow(tree), "grown_shard")
    rows = scratch.table(rows.withColumn("_row", F.monotonically_increasing_id()), "sharded")
    counts = {row["shard"]: row["count"] for row in rows.groupBy("shard").count().collect()}  # one row per shard
    first, starts = 0, []
    for shard in sorted(counts):
        starts += [F.lit(shard), F.lit(first).cast("long")]
        first += counts[shard]
    placed = assign_ids(rows, "_place", scratch, ["shard", "doc_id", "_row"], start=0)
    before = F.create_map(*starts)[F.col("shard")] if starts else F.lit(0).cast("long")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_place") - before).alias("slot"), "grown_shard",
    )
