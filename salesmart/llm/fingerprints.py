"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the smallest hash among its inner s-mers is the first or
the last one. The choice depends on the k-mer alone, so equal passages give equal anchors wherever they
stand, and the anchors of a text put together from parts are those of the parts plus the few across the seams.
A fingerprint is the sorted list of the ``SKETCH`` smallest 32-bit anchor hashes, eight hex digits each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

S, W = 8, 4  # inner length, inner substrings per k-mer
K = S + W - 1
SKETCH = 64
#: Doc_ids are dealt to this many ranges per shuffle partition to find each document's successor.
RANGES = 2


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column) -> Column:
    """By position of each k-mer: its 32-bit hash if it is a closed syncmer, else null.

    The pattern takes one code point at a time; an empty match would step into surrogate pairs.
    """
    inner = F.transform(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{S}}}))."), F.lit(1)), lambda s: F.xxhash64(s))

    def close(h: Column) -> Column:
        def one(first: Column, i: Column) -> Column:
            last = F.get(h, i + (W - 1))
            middle = [F.get(h, i + j) for j in range(1, W - 1)]
            smallest = F.least(*middle) if len(middle) > 1 else middle[0]
            return F.when(F.least(first, last) <= smallest, F.shiftrightunsigned(F.xxhash64(first, last), 32))

        return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (W - 1), F.lit(0))), one)

    return _let(inner, close)


def smallest(hashes: Column, number: int = SKETCH) -> Column:
    """The ``number`` smallest distinct hashes in order.

    Hashes are spread evenly, so a cut that should leave four times as many is tried first, and sorting
    everything is kept for lists where it leaves too few.
    """

    def pick(all_: Column) -> Column:
        cut = F.least(F.lit(4.0 * number) / F.greatest(F.size(all_), F.lit(1)), F.lit(1.0)) * float(1 << 32)
        low = F.array_distinct(F.filter(all_, lambda h: h <= cut))
        whole = lambda: F.sort_array(F.array_distinct(all_))
        return _let(low, lambda x: F.slice(F.when(F.size(x) >= number, F.sort_array(x)).otherwise(whole()), 1, number))

    return _let(hashes, pick)


def whole_hash(text: Column) -> Column:
    """What a text shorter than a k-mer has for an anchor: the hash of all of it; an empty text has none."""
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(F.array(F.shiftrightunsigned(F.xxhash64(text), 32)))


def hexed(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def likeness(a: Column, b: Column, number: int = SKETCH) -> Column:
    """Estimated Jaccard similarity of two texts' anchors: what both hold of the smallest of either.

    Two empty texts are alike (1), an empty and another one are not (0).
    """
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, number)
    ratio = F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.nullif(F.size(union), F.lit(0))
    return F.coalesce(ratio, F.lit(1.0)).cast("double")


def fingerprinted(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, sketch and fingerprint of every row; a null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sketch = _sketch(text, anchors(text))
    rows = documents.select("doc_id", F.char_length(text).cast("long").alias("n_chars"), sketch.alias("sketch"))
    return rows.select("*", hexed(F.col("sketch")).alias("fingerprint"))


def _sketch(text: Column, found: Column) -> Column:
    return F.when(F.char_length(text) < K, whole_hash(text)).otherwise(smallest(F.array_compact(found)))


def with_guards(rows: DataFrame) -> DataFrame:
    """Deal (doc_id, text, ...) rows to ranges of doc_id, so that no window has to hold the whole table.

    A range's last row needs the first of the next range: those rows, one per range, are found by id and
    appended to the range before as guards. Adds ``_range``, ``_tie`` and ``_guard``.
    """
    spark = rows.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    ids = rows.select("doc_id", "_tie")
    shares = [i / ranges for i in range(1, ranges)]
    bounds = ids.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []
    bounds = sorted(set(bounds))  # at most one per range
    # ranges are numbered from the highest ids down; null ids come after all others
    below = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b >= F.col("doc_id"))) if bounds else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(below).cast("int")
    order = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("doc_id"), "_tie")
    heads = ids.withColumn("_range", bucket).groupBy("_range").agg(F.max(order).alias("head")).orderBy("_range").collect()  # one row per range
    rows = rows.withColumn("_range", bucket)
    if not heads:
        return rows.withColumn("_guard", F.lit(0))
    follows = [(row["_range"], heads[(i + 1) % len(heads)]["head"]) for i, row in enumerate(heads)]
    wanted = [(before, head["_tie"], None if head["doc_id"] == -(1 << 63) else head["doc_id"]) for before, head in follows]
    guards = spark.createDataFrame(wanted, "_before int, _head_tie long, _head_id long")
    found = rows.join(F.broadcast(guards), F.col("doc_id").eqNullSafe(F.col("_head_id")) & (F.col("_tie") == F.col("_head_tie")))
    # rows that repeat id and text are the same row here
    found = found.dropDuplicates(["_before"]).withColumn("_range", F.col("_before")).drop("_before", "_head_tie", "_head_id")
    return rows.withColumn("_guard", F.lit(0)).unionByName(found.withColumn("_guard", F.lit(1)))


def with_next(guarded: DataFrame, carried: list[str]) -> DataFrame:
    """Add the ``carried`` columns of the next row by descending doc_id (after the last: the first).

    Equal and null ids (null last) follow each other by hash of the text. Guards are left out again.
    """
    after = Window.partitionBy("_range").orderBy("_guard", F.desc_nulls_last("doc_id"), F.desc("_tie"))
    rows = guarded.withColumns({f"next_{name}": F.lead(name).over(after) for name in carried})
    return rows.where("_guard = 0").drop("_guard", "_range", "_tie")


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses; see the query's contract.

    Reads doc_id and text only. A null text is empty; equal texts have equal fingerprints; repeated rows follow each
    other; a table of one row is followed by that row itself; an empty table gives no rows.
    Anchors of the edited text are those of the part that stays, already found, and those of the seam and the part
    put in, so only a third of it is searched again.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = F.char_length(text)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), n.cast("int").alias("_n"))
    rows = with_guards(rows.withColumn("_cut", F.floor(F.col("_n") / 3).cast("int")))
    stays = F.col("_n") - F.col("_cut")

    def both(found: Column) -> Column:
        kept = F.slice(found, F.lit(1), F.greatest(stays - (K - 1), F.lit(0)))
        return F.struct(
            F.when(F.col("_n") < K, whole_hash(F.col("text"))).otherwise(smallest(F.array_compact(found))).alias("own"),
            smallest(F.array_compact(kept)).alias("kept"),
        )

    rows = rows.withColumn("_sketches", _let(anchors(F.col("text")), both))
    rows = rows.select("doc_id", "text", "_n", "_cut", "_range", "_tie", "_guard", F.col("_sketches.own").alias("own"), F.col("_sketches.kept").alias("kept"))
    rows = with_next(rows, ["text", "own"])
    head, tail = F.left("text", stays), F.left("next_text", F.col("_cut"))
    rows = rows.withColumn("_head", F.when(F.col("_cut") > 0, head).otherwise(F.col("text"))).withColumn("_tail", F.when(F.col("_cut") > 0, tail).otherwise(""))
    seam = F.concat(F.right("_head", F.lit(K - 1)), F.col("_tail"))
    rows = rows.withColumn("_edited", F.concat("_head", "_tail")).withColumn("_seam", seam)
    together = F.slice(F.sort_array(F.array_union("kept", smallest(F.array_compact(anchors(F.col("_seam")))))), 1, SKETCH)
    sketch = F.when(F.char_length("_edited") < K, whole_hash(F.col("_edited"))).otherwise(together)
    rows = rows.select("doc_id", "_n", F.sha2("_edited", 256).alias("edited_sha256"), "own", "next_own", sketch.alias("edited"))
    return rows.select(
        "doc_id",
        F.col("_n").cast("long").alias("n_chars"),
        "edited_sha256",
        hexed(F.col("own")).alias("fingerprint"),
        hexed(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
