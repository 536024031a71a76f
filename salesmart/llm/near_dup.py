"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

1. Shingles of five words weigh tf x idf. Document frequencies are counted for all documents in ``COUNTERS``
   hashed counters; idf = ln(N / df), at most ln(RARE), so only counters of at least N / RARE
   matter and a fixed table holds them. Rare shingles weigh alike, widely shared passages down to a
   ``CONTRAST``-th of them: no less, or else the members of a very large group would look different.
2. Every text gets ``BANDS`` x ``ROWS`` consistent weighted samples; texts that agree on a band meet in a bucket.
3. A bucket's texts are compared by samples with its pivots: a text joins the family of every pivot at an
   estimated similarity of ``JOINS`` or more, and becomes a pivot below ``PIVOT``. Since 1 - similarity is a
   metric, texts of similarity ``SIMILAR`` in one bucket end up in one family. A bucket of more than ``HOT_BUCKET``
   texts is split, and each part compares its texts with the pivots of all parts.
4. Within a family, all texts are compared exactly in blocks; only links that connect new parts are kept.
5. Classes are the connected components of the links; equal texts are one text throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmart.llm import graphs, kernels
from salesmart.llm.tasks import ship, small_batches, tidy, worker_cache
from salesmart.operators.lookups import is_small
from salesmart.storage import Scratch

WIDTH = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 4
PIVOT, JOINS = 0.55, 0.3
RARE = 200
CONTRAST = 4.0
COUNTERS = 1 << 20
SLICE = 1 << 16
BLOCK = 400
HOT_BUCKET = 50_000
CHUNK_BYTES = 1 << 19
_DRAWS = 1 << 16


def shingled(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: 52-bit hashes in order, how often each occurs, and offsets by text.

    A text with fewer words than ``width`` has one shingle, its words; one without words has none.
    """
    buffer, starts, _ = kernels.joined(texts, 1, fold=False)
    begin, words = kernels.words(buffer)
    offsets = kernels.by_text(begin, starts)
    sizes = np.diff(offsets)
    hashes = np.zeros(len(words), np.uint64)
    for j in range(width):
        # words beyond the end of a text are left out, which also covers short texts
        shifted = np.zeros(len(words), np.uint64)
        shifted[: max(len(words) - j, 0)] = words[j:]
        hashes = kernels.mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + shifted)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - offsets[text] if len(words) else np.zeros(0, np.int64)
    whole = place <= np.repeat(sizes - width, sizes)
    for i in np.flatnonzero((sizes > 0) & (sizes < width)):
        first, own = offsets[i], words[offsets[i] : offsets[i + 1]]
        state = np.array([len(own)], np.uint64)
        for word in own:
            state = kernels.mixed(state * np.uint64(3) ^ word)
        hashes[first], whole[first] = state[0], True
    packed = np.sort((text[whole].astype(np.uint64) << np.uint64(52)) | (hashes[whole] >> np.uint64(12)))
    new = np.concatenate([[True], packed[1:] != packed[:-1]]) if len(packed) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    times = np.diff(np.concatenate([at, [len(packed)]]))
    distinct = packed[at]
    offsets = np.searchsorted((distinct >> np.uint64(52)).astype(np.int64), np.arange(len(sizes) + 1))
    return distinct & np.uint64((1 << 52) - 1), times, offsets


def parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most 4,096 texts (12 bits number a text within its slice)."""
    for part in kernels.chunks(batch, column, CHUNK_BYTES):
        for at in range(0, part.num_rows, 4096):
            yield part.slice(at, 4096)


def frequencies(documents: DataFrame) -> DataFrame:
    """(counter, df) of the hashed counters that hold at least a 1 / RARE share of all documents' shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in parts(batch, "text"):
                hashes, _, _ = shingled(part.column("text"))
                total += np.bincount((hashes & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        yield from _slices(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for number, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                total[number * SLICE : (number + 1) * SLICE] += np.frombuffer(counts, np.int64)
        yield from _slices(total)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add(batches):
            counts = np.frombuffer(batch.column("counts")[0].as_py(), np.int64)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at + batch.column("slice")[0].as_py() * SLICE), pa.array(counts[at])], names=["counter", "df"])

    schema = "slice int, counts binary"
    partial = documents.select("text").mapInArrow(tidy(count), schema)
    # counters of many tasks are added in two steps, slice by slice
    partial = partial.repartition(64, "slice", F.pmod(F.monotonically_increasing_id(), F.lit(4))).mapInArrow(tidy(add), schema)
    return partial.repartition(COUNTERS // SLICE, "slice").mapInArrow(tidy(spread), "counter long, df long")


def _slices(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for number in range(COUNTERS // SLICE):
        piece = total[number * SLICE : (number + 1) * SLICE]
        if piece.any():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([piece.tobytes()], pa.binary())], names=["slice", "counts"])


class Weights:
    """Broadcast idf: float16-sized table of the frequent counters (at most COUNTERS of them)."""

    def __init__(self, spark, documents: DataFrame, scratch: Scratch):
        counts = scratch.table(frequencies(documents), "frequencies")
        n = documents.count()
        frequent = counts.where(F.col("df") * RARE >= n).toArrow()
        most = math.log(min(RARE, n + 1) + 1)
        table = np.full(COUNTERS, most, np.float32)
        if n:
            df = frequent.column("df").to_numpy()
            table[frequent.column("counter").to_numpy()] = np.clip(np.log(n / np.minimum(df, n)), most / CONTRAST, most)
        self.shipped = spark.sparkContext.broadcast(table)

    def of(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        return self.shipped.value[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)] * times.astype(np.float32)


def _draws() -> dict:
    cache = worker_cache("draws")
    if not cache:
        rng = np.random.default_rng(20240229)
        r = rng.gamma(2.0, 1.0, _DRAWS).astype(np.float32)
        cache |= {"r": r, "inverse": 1 / r, "beta": rng.random(_DRAWS, np.float32), "log_c": np.log(rng.gamma(2.0, 1.0, _DRAWS)).astype(np.float32)}
        cache["odd"] = rng.integers(1, 1 << 63, 4 * BANDS * ROWS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
    return cache


def samples(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, number: int) -> np.ndarray:
    """Improved consistent weighted sampling: ``number`` samples (shingle and level, hashed) per text.

    For each shingle: t = floor(ln w / r + beta), ln y = r (t - beta), ln a = ln c - ln y - r, with r and c
    from Gamma(2, 1) and beta uniform, all drawn by the shingle's hash; the smallest a is sampled. Texts without shingles
    get samples 0.
    """
    draws = _draws()
    filled = np.flatnonzero(np.diff(offsets))
    result = np.zeros((len(offsets) - 1, number), np.uint64)
    if not len(filled):
        return result
    begin, sizes = offsets[filled], np.diff(offsets)[filled]
    log_w = np.log(weights)
    for j in range(number):
        mixed = (hashes ^ (hashes >> np.uint64(23))) * draws["odd"][j]
        i = (mixed >> np.uint64(48)).astype(np.int64)
        r = draws["r"][i]
        beta = draws["beta"][((mixed >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)]
        log_c = draws["log_c"][((mixed >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
        t = np.floor(log_w * draws["inverse"][i] + beta)
        a = log_c - r * (t - beta + 1)
        least = np.minimum.reduceat(a, begin)
        at = np.flatnonzero(a == np.repeat(least, sizes))
        first = at[np.searchsorted(at, begin)]
        result[filled, j] = kernels.mixed(hashes[first] * np.uint64(31) + t[first].astype(np.int64).astype(np.uint64))
    return result


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (hashes, weights); the brute-force form."""
    left, right = dict(zip(*[x.tolist() for x in a])), dict(zip(*[x.tolist() for x in b]))
    low = sum(min(w, right.get(h, 0.0)) for h, w in left.items())
    high = sum(left.values()) + sum(right.values()) - low
    return low / high if high else 0.0


class _Forest:
    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        while self.up.get(x, x) != x:
            self.up[x] = self.up.get(self.up[x], self.up[x])
            x = self.up[x]
        return x

    def join(self, x: bytes, y: bytes) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def compare(block: list[tuple], other: list[tuple] | None, similar: float) -> list[tuple[bytes, bytes, float]]:
    """Links that connect new parts among ``block`` x ``block`` (or x ``other``): (a, b, similarity).

    Texts are (key, hashes, weights, times). A pair links at a weighted Jaccard similarity of ``similar``, or when its
    plain shingle sets reach it: idf shrinks what the members of a large group share.
    """
    everyone = block if other is None else other
    if not block or not everyone:
        return []
    hashes = np.concatenate([x[1] for x in everyone])
    owner = np.repeat(np.arange(len(everyone)), [len(x[1]) for x in everyone])
    weight = np.concatenate([x[2] for x in everyone])
    order = np.argsort(hashes, kind="stable")
    hashes, owner, weight = hashes[order], owner[order], weight[order]
    totals = np.array([x[2].sum() for x in everyone], np.float64)
    sizes = np.array([len(x[1]) for x in everyone])
    forest, links = _Forest(), []
    for i, (key, own, own_weight, *_) in enumerate(block):
        low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
        counts = high - low
        at = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        shared = np.bincount(owner[at], minlength=len(everyone))
        both = np.bincount(owner[at], np.minimum(weight[at], np.repeat(own_weight, counts)), minlength=len(everyone))
        with np.errstate(invalid="ignore", divide="ignore"):
            close = np.maximum(both / (own_weight.sum() + totals - both), shared / (len(own) + sizes - shared))
        for j in np.flatnonzero(close >= similar - 1e-9):
            if everyone[j][0] != key and forest.join(key, everyone[j][0]):
                links.append((key, everyone[j][0], float(min(close[j], 1.0))))
    return links


def classes(documents: DataFrame, scratch: Scratch, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, text_key, class_key, class_id, class_size, n_rows) for every distinct (doc_id, text).

    Reads doc_id and text only. A null text is an empty one; texts without words are alike only if equal.
    Rows that repeat doc_id and text are one entry with ``n_rows`` rows. class_id is the smallest doc_id of the class
    (null only if all are null). An empty table gives no rows.
    """
    with small_batches(documents.sparkSession):  # all that passes Arrow is written in here
        return _classes(documents, scratch, similar)


def _classes(documents: DataFrame, scratch: Scratch, similar: float) -> DataFrame:
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))
    members = scratch.table(rows.groupBy("text_key", "doc_id").agg(F.count("*").alias("n_rows")), "members")
    keepers = members.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))  # one row per text
    weigh = Weights(spark, rows, scratch)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                hashes, times, offsets = shingled(part.column("text"))
                drawn = samples(hashes, weigh.of(hashes, times), offsets, BANDS * ROWS)
                bands = np.zeros((part.num_rows, BANDS), np.uint64)
                for band in range(BANDS):
                    bands[:, band] = band
                    for row in range(ROWS):
                        bands[:, band] = kernels.mixed(bands[:, band] * np.uint64(31) + drawn[:, band * ROWS + row])
                some = np.diff(offsets) > 0
                low = (drawn & np.uint64(0xFFFF)).astype(np.uint16)  # enough to compare samples with
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("text_key").filter(pa.array(some)),
                        pa.array(list(bands[some].view(np.int64)), pa.list_(pa.int64())),
                        pa.array([x.tobytes() for x in low[some]], pa.binary()),
                    ],
                    names=["text_key", "bands", "samples"],
                )

    sketches = rows.mapInArrow(tidy(sketch), "text_key binary, bands array<long>, samples binary")
    sketches = scratch.table(sketches.groupBy("text_key").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples")), "sketches")
    placed = sketches.select("text_key", F.explode("bands").alias("bucket"))
    shared = scratch.table(placed.groupBy("bucket").agg(F.count("*").alias("_texts")).where("_texts > 1"), "buckets")
    met = placed.join(F.broadcast(shared) if is_small(shared) else shared, "bucket")
    # a bucket of very many texts is spread over several, and each of them gets the pivots of all
    salts = F.ceil(F.col("_texts") / HOT_BUCKET)
    salt = F.pmod(F.xxhash64("text_key", "bucket"), salts)
    met = scratch.table(met.select("text_key", "bucket", salt.alias("_salt"), salts.alias("_salts")), "met")
    drawn = sketches.select("text_key", "samples")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "_salt").sortWithinPartitions("bucket", "_salt", "_text", "text_key")

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, matrix = None, None
        for batch in batches:
            new = []
            places = zip(batch.column("bucket").to_pylist(), batch.column("_salt").to_pylist())
            for n, (place, drawn) in enumerate(zip(places, batch.column("samples").to_pylist())):
                own = np.frombuffer(drawn, np.uint16)
                if place != current:
                    current, matrix = place, own[None, :]
                elif (matrix == own).mean(axis=1).max() < PIVOT:
                    matrix = np.concatenate([matrix, own[None, :]])
                else:
                    continue
                new.append(n)
            yield batch.take(pa.array(new, pa.int64())).select(["bucket", "_salts", "text_key", "samples"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pivots, matrix, forest = None, [], None, _Forest()
        for batch in batches:
            found = []
            places = zip(batch.column("bucket").to_pylist(), batch.column("_salt").to_pylist())
            columns = (batch.column(name).to_pylist() for name in ("text_key", "samples", "_text"))
            for place, key, drawn, text in zip(places, *columns):
                own = np.frombuffer(drawn, np.uint16)
                if place != current:
                    current, pivots, matrix, forest = place, [key], own[None, :], _Forest()
                    continue
                if not text:  # a pivot of the whole bucket, ahead of the texts
                    pivots.append(key)
                    matrix = np.concatenate([matrix, own[None, :]])
                    continue
                alike = (matrix == own).mean(axis=1)
                # only what connects new parts of the bucket: fewer edges than texts
                found += [(key, pivots[i]) for i in np.flatnonzero(alike >= JOINS) if forest.join(key, pivots[i])]
                if alike.max() < PIVOT:
                    pivots.append(key)
                    matrix = np.concatenate([matrix, own[None, :]])
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.binary())], names=["a", "b"])

    texts = met.join(drawn, "text_key").select("bucket", "_salt", "_salts", "text_key", "samples", F.lit(True).alias("_text"))
    hot = met.where("_salts > 1")
    if hot.limit(1).count():
        # a text is near a pivot of its own part, and any text near that text compares itself with this pivot
        split = dealt(texts.where("_salts > 1")).select("bucket", "_salt", "_salts", "text_key", "samples")
        leads = scratch.table(split.mapInArrow(tidy(lead), "bucket long, _salts long, text_key binary, samples binary"), "pivots")
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt")
        leads = leads.select("bucket", each, "_salts", "text_key", "samples", F.lit(False).alias("_text"))
        texts = texts.unionByName(leads)
    candidates = dealt(texts).select("bucket", "_salt", "text_key", "samples", "_text").mapInArrow(tidy(gather), "a binary, b binary")
    families = scratch.table(graphs.components(candidates, scratch), "families")
    sizes = families.groupBy("component").agg(F.count("*").alias("_members"))
    # every pair of blocks of a family meets once: block i with itself and with each later one
    blocks = F.ceil(F.col("_members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    chosen = families.join(sizes, "component").select("component", F.col("node").alias("text_key"), own.alias("_block"), blocks.alias("_blocks"))
    # one row of each text, found by id as well, so that copies of one text are not shuffled together
    known = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    chosen = scratch.table(chosen.join(keepers, "text_key").withColumn("_id", known).drop("doc_id"), "chosen")
    texts = rows.withColumn("_id", known).join(F.broadcast(chosen) if is_small(chosen) else chosen, ["text_key", "_id"])
    texts = texts.select("text_key", "text", "component", "_block", "_blocks")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: F.struct(F.least(b, F.col("_block")).alias("i"), F.greatest(b, F.col("_block")).alias("j")))
    meetings = texts.withColumn("_pair", F.explode(pairs)).select("component", "_pair.i", "_pair.j", "_block", "text_key", "text")
    meetings = meetings.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "text_key")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(place, held):
            unique = {x[0]: x for x in held}  # repeated rows of one doc_id and text
            if place[1] == place[2]:
                return compare([x[1:] for x in unique.values()], None, similar)
            left, right = ([x[1:] for x in unique.values() if x[5] == side] for side in place[1:])
            return compare(left, right, similar)

        current, held = None, []
        for batch in batches:
            found = []
            for part in parts(batch, "text"):
                hashes, times, offsets = shingled(part.column("text"))
                weights = weigh.of(hashes, times)
                places = zip(part.column("component").to_pylist(), part.column("i").to_pylist(), part.column("j").to_pylist())
                for n, (place, key, block) in enumerate(zip(places, part.column("text_key").to_pylist(), part.column("_block").to_pylist())):
                    if place != current:
                        if len(held) > 1:
                            found += done(current, held)
                        current, held = place, []
                    here = slice(offsets[n], offsets[n + 1])
                    held.append((key, key, hashes[here].copy(), weights[here].copy(), None, block))
            yield _links(found)
        if len(held) > 1:
            yield _links(done(current, held))

    links = scratch.table(meetings.mapInArrow(tidy(link), "a binary, b binary, similarity double"), "links")
    named = scratch.table(graphs.components(links.select("a", "b"), scratch), "classes")
    named = members.join(F.broadcast(named) if is_small(named) else named, F.col("text_key") == F.col("node"), "left")
    named = scratch.table(named.select("doc_id", "text_key", "n_rows", F.coalesce("component", "text_key").alias("class_key")), "named")
    # a class may hold a third of all rows: minima and counts are taken before the shuffle and joined back
    tops = named.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.sum("n_rows").alias("class_size"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("_top"))
    tops = scratch.table(tops, "tops")
    result = named.join(F.broadcast(tops) if is_small(tops) else tops, "class_key")
    kept = F.col("_top.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_top.text_key") == F.col("text_key"))
    return result.select("doc_id", "text_key", "class_key", "class_id", "class_size", "n_rows", kept.alias("kept"))


def _links(found: list[tuple[bytes, bytes, float]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.float64())], names=["a", "b", "similarity"])


ship(__name__)
ship(kernels.__name__)


def near_duplicates(documents: DataFrame, scratch: Scratch, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``documents``: doc_id, class_id, class_size (rows), kept (the class's first document).

    Of rows that repeat a kept document, one is kept.
    """
    found = classes(documents, scratch, similar)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))
    return found.withColumn("_copy", copies).select("doc_id", "class_id", "class_size", (F.col("kept") & (F.col("_copy") == 1)).alias("kept"))


def kept_documents(documents: DataFrame, scratch: Scratch, similar: float = SIMILAR) -> DataFrame:
    """One document of each class, with all its columns."""
    kept = scratch.table(classes(documents, scratch, similar).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("n_rows").alias("_rows")), "kept")
    key = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    keyed = documents.select(F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_document"), key.alias("_text_key"), F.col("doc_id").cast("long").alias("_doc_id"))
    joined = keyed.join(F.broadcast(kept) if is_small(kept) else kept, (F.col("_text_key") == F.col("_key")) & F.col("_doc_id").eqNullSafe(F.col("_id")))
    once = joined.where("_rows = 1").select("_document.*")
    if kept.where("_rows > 1").limit(1).count() == 0:
        return once
    return once.unionByName(joined.where("_rows > 1").dropDuplicates(["_key", "_id"]).select("_document.*"))
