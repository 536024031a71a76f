"""Byte-level language model by context-tree weighting.

Each byte is eight binary decisions, and each decision has one context tree over the bytes before it, up
to ``DEPTH``. A node's counts give the Krichevsky-Trofimov estimate of its own decisions; weighting a
node against its children, from the leaves up over all training counts, gives every node the share with which
its own estimate enters the mixture over all depths. Scoring uses these frozen shares.

Training counts are those of the distinct (DEPTH + 1)-byte grams, summed by Spark over the whole corpus; node counts
and shares follow by one aggregation per depth. Texts are lower-cased (A-Z), begin in a context of
edge bytes and end with one edge byte, which is coded, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm import kernels
from salesmart.llm.tasks import ship, small_batches, tidy, worker_cache
from salesmart.storage import Scratch

DEPTH = 4
CHUNK_BYTES = 1 << 20
MOST_NODES = 1 << 21  # 32 MB of broadcast keys, estimates and shares; all other nodes are joined
MOST_WORDS = 1 << 20  # 16 MB of broadcast word counts
COUNTS_HELD = 1 << 20  # rows of counts that a task adds up before it hands them on
CODES_KEPT = 1 << 19  # grams whose code lengths a worker keeps
END_WORD = -1  # hash value that stands for the end token
_GRAM, _WORD = 0, 1


def held_out(doc_id: Column, part: int = 10, remainder: int = 0) -> Column:
    """Whether the CRC-32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % part == remainder


def added(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several (keys, n), in order, and the sums of their n."""
    keys, n = (np.concatenate(x) for x in zip(*tables))
    order = np.argsort(keys, kind="stable")  # merges what is in order already
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def counted(training: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, key, n): counts of grams and of words by hash over all texts of ``training``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {_GRAM: [], _WORD: []}
        for batch in batches:
            for part in kernels.chunks(batch, "text", CHUNK_BYTES):
                buffer, starts, ends = kernels.joined(part.column("text"), depth)
                inside = np.ones(len(buffer), bool)
                for lead in range(1, depth + 1):
                    inside[starts - lead] = False
                distinct, index = kernels.grams(buffer, np.flatnonzero(inside), depth + 1)
                held[_GRAM].append((distinct.view(np.int64), np.bincount(index, minlength=len(distinct))))
                held[_WORD] += [np.unique(kernels.words(buffer)[1].view(np.int64), return_counts=True), (np.array([END_WORD]), np.array([len(starts)]))]
                for kind, tables in held.items():
                    if sum(len(keys) for keys, _ in tables) > COUNTS_HELD:
                        tables[:] = [added(tables)]
                        if len(tables[0][0]) > COUNTS_HELD // 2:
                            yield from rows(kind, *tables.pop())
        for kind, tables in held.items():
            if tables:
                yield from rows(kind, *added(tables))

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), 1 << 17):
            here = slice(at, at + (1 << 17))
            kinds = np.full(len(keys[here]), kind, np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys[here]), pa.array(n[here])], names=["kind", "key", "n"])

    return training.select("text").mapInArrow(tidy(count), "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after six steps of the recurrence; exact to about 1e-10 for x >= 1/2."""
    z = x + 6
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7)) - F.log(steps)


def _log_kt(zeros: Column, ones: Column) -> Column:
    """Log probability that KT estimates give to any sequence of so many zeros and ones."""
    a, b = zeros.cast("double"), ones.cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1)


def node_table(grams: DataFrame, scratch: Scratch, depth: int = DEPTH) -> DataFrame:
    """(level, context, node, n, p1, own): each node's count, KT estimate of a one, and its own share."""
    byte = F.col("key").bitwiseAND(F.lit(255))
    bits = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_k")
    rows = grams.select(F.shiftrightunsigned("key", 8).alias("context"), byte.alias("_byte"), "n", bits)
    power = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), F.col("_k") + 1)
    over = F.element_at(F.array(*[F.lit(1 << (8 - k)) for k in range(8)]), F.col("_k") + 1)
    below = F.element_at(F.array(*[F.lit(1 << (7 - k)) for k in range(8)]), F.col("_k") + 1)
    node = (power + F.floor(F.col("_byte") / over)).cast("int")
    one = F.floor(F.col("_byte") / below).cast("int").bitwiseAND(F.lit(1)) == 1
    level = rows.select("context", node.alias("node"), F.when(one, 0).otherwise(F.col("n")).alias("zeros"), F.when(one, F.col("n")).otherwise(0).alias("ones"))
    level = level.groupBy("context", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    level = level.withColumn("log_pw", _log_kt(F.col("zeros"), F.col("ones"))).withColumn("own", F.lit(1.0))
    tables = []
    for d in range(depth, -1, -1):
        level = scratch.table(level, f"level{d}")
        n = F.col("zeros") + F.col("ones")
        tables.append(level.select(F.lit(d).alias("level"), "context", "node", n.alias("n"), ((F.col("ones") + 0.5) / (n + 1)).alias("p1"), "own"))
        if d:
            shorter = F.col("context").bitwiseAND(F.lit((1 << (8 * (d - 1))) - 1)) if d > 1 else F.lit(0).cast("long")
            level = level.groupBy(shorter.alias("context"), "node").agg(
                F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_pw").alias("_children")
            )
            kt = _log_kt(F.col("zeros"), F.col("ones"))
            gap = F.col("_children") - F.col("_kt")  # own share 1 / (1 + e^gap)
            level = (
                level.withColumn("_kt", kt)
                .withColumn("own", F.when(gap > 700, 0.0).otherwise(1 / (1 + F.exp(F.least(gap, F.lit(700.0))))))
                .withColumn("log_pw", math.log(0.5) + F.greatest("_kt", "_children") + F.log1p(F.exp(-F.abs(gap))))
                .drop("_kt", "_children")
            )
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def _least_count(table: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` rows have it or more."""
    if table.count() <= most:
        return 0
    steps = table.groupBy(F.ceil(F.log2("n") * 16).alias("_step")).count().orderBy(F.desc("_step")).collect()  # a few hundred rows
    total = 0
    for row in steps:
        total += row["count"]
        if total > most:
            return int(2 ** (row["_step"] / 16)) + 1
    return 0


def _arrays(table: DataFrame, *columns: str) -> list[np.ndarray]:
    read = table.select(*columns).toArrow()
    return [read.column(name).to_numpy() for name in columns]


def _node_key(level: np.ndarray | int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(12)) | (node.astype(np.uint64) << np.uint64(4)) | np.uint64(level)


def _keys(grams: np.ndarray, depth: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Bit, level and node keys of the eight decisions of each gram's last byte, deepest level first."""
    byte = (grams & np.uint64(255)).astype(np.int64)
    context = grams >> np.uint64(8)
    for k in range(8):
        node = (1 << k) | (byte >> (8 - k))
        for d in range(depth, -1, -1):
            yield k, d, _node_key(d, context & np.uint64((1 << (8 * d)) - 1), node)


def _code_lengths(grams: np.ndarray, model: dict, depth: int, rare: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Log10 probability of the last byte of each gram after the bytes before it, and whether a node was not found.

    ``rare`` holds, by slot (see ``_slot``), the places of grams and the estimates and shares of nodes that
    ``model`` lacks.
    """
    byte = (grams & np.uint64(255)).astype(np.int64)
    total, short = np.zeros(len(grams)), np.zeros(len(grams), bool)
    for k, d, keys in _keys(grams, depth):
        at = model["nodes"].find(keys)
        p, own, seen = model["p1"][at], model["own"][at], at >= 0
        if rare is not None and _slot(k, d, depth) in rare:
            place, rare_p, rare_own = rare[_slot(k, d, depth)]
            p[place], own[place], seen[place] = rare_p, rare_own, True
        short |= ~seen
        if d == depth:
            q = np.where(seen, p, np.nan)
        else:
            # a context that training never saw leaves the decision to the shorter one
            here = np.where(np.isnan(q), p, own * p + (1 - own) * q)
            q = np.where(seen, here, np.nan)
        if d == 0:
            q = np.where(np.isnan(q), 0.5, q)
            total += np.log10(np.where((byte >> (7 - k)) & 1 == 1, q, 1 - q))
    return total, short


def _slot(k: int, d: int, depth: int) -> int:
    return k * (depth + 1) + d


def _kept_code_lengths(grams: np.ndarray, cache: dict, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``_code_lengths`` of distinct grams in order; a worker works out a gram once while ``cache`` keeps it.

    When more than ``CODES_KEPT`` would be kept, those of ``grams`` alone stay.
    """
    kept, bits, short = cache.get("codes") or (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, bool))
    at = np.searchsorted(kept, grams)
    known = at < len(kept)
    known[known] = kept[at[known]] == grams[known]
    new = grams[~known]
    new_bits, new_short = _code_lengths(new, cache, depth)
    own_bits, own_short = np.empty(len(grams)), np.empty(len(grams), bool)
    own_bits[known], own_short[known] = bits[at[known]], short[at[known]]
    own_bits[~known], own_short[~known] = new_bits, new_short
    if len(kept) + len(new) > CODES_KEPT:
        cache["codes"] = grams, own_bits, own_short
    elif len(new):
        place = at[~known]
        cache["codes"] = np.insert(kept, place, new), np.insert(bits, place, new_bits), np.insert(short, place, new_short)
    return own_bits, own_short


def scored(documents: DataFrame, scratch: Scratch, training: Column, depth: int = DEPTH) -> DataFrame:
    """Word-count base and model score for every row of ``documents``, learning from rows where ``training`` holds.

    Reads doc_id and text only; extra columns play no part. A null or empty text is the end token alone.
    Repeated rows count and are scored each. Without training rows the model codes every bit at 1/2 and
    the base sees no known token. An empty table gives no rows.

    Counts cover all training rows, and every node plays its part: the MOST_NODES most frequent ones are broadcast,
    and grams that need another one are coded once each, after a join with all other nodes. Likewise counts of the
    MOST_WORDS most frequent words are broadcast and all others reach their documents by a join.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), training.alias("_training"))
    with small_batches(spark):
        counts = scratch.table(counted(rows.where("_training"), depth), "counts")
    nodes = node_table(counts.where(F.col("kind") == _GRAM), scratch, depth)
    nodes = scratch.table(nodes, "nodes")
    least_node = _least_count(nodes, MOST_NODES)
    words = counts.where(F.col("kind") == _WORD).select("key", "n")
    size = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = size["tokens"] or 0, size["distinct"]
    least = max(1, _least_count(words, MOST_WORDS))

    key = F.shiftleft("context", 12).bitwiseOR(F.shiftleft(F.col("node").cast("long"), 4)).bitwiseOR(F.col("level").cast("long"))
    nodes = nodes.select(key.alias("key"), "n", F.col("p1").cast("float").alias("p1"), F.col("own").cast("float").alias("own"))
    hot = kernels.in_order(*_arrays(nodes.where(F.col("n") >= least_node), "key", "p1", "own"))
    shipped = spark.sparkContext.broadcast((hot, kernels.in_order(*_arrays(words.where(F.col("n") >= least), "key", "n"))))
    token = scratch.path

    def loaded() -> dict:
        cache = worker_cache("ctw", large=True)
        if cache.get("token") != token:
            cache.clear()
            (keys, p, own), (word_keys, word_counts) = shipped.value
            cache |= {"token": token, "nodes": kernels.Lookup(keys), "p1": p, "own": own, "words": kernels.Lookup(word_keys), "counts": word_counts}
        return cache

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = loaded()
        for batch in batches:
            for part in kernels.chunks(batch, "text", CHUNK_BYTES):
                buffer, starts, ends = kernels.joined(part.column("text"), depth)
                inside = np.ones(len(buffer), bool)
                for lead in range(1, depth + 1):
                    inside[starts - lead] = False
                places = np.flatnonzero(inside)
                distinct_grams, index = kernels.grams(buffer, places, depth + 1)
                bits, short = _kept_code_lengths(distinct_grams, cache, depth)
                later = (short & (least_node > 0))[index]  # without other nodes, what is not found does not exist
                bits = np.where(later, 0.0, bits[index])
                by_text = kernels.by_text(places, starts)
                later_before = np.concatenate([[0], np.cumsum(later)])[by_text]
                begin, hashes = kernels.words(buffer)
                unique, which = np.unique(hashes, return_inverse=True)
                at = cache["words"].find(unique)
                known = cache["counts"][at]
                listed = (at >= 0)[which]
                logs = np.where(at >= 0, np.log10(known + 0.1), 0.0)[which]
                offsets = kernels.by_text(begin, starts)
                rare_before = np.concatenate([[0], np.cumsum(~listed)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_training"),
                        pa.array(np.diff(offsets) + 1),
                        pa.array(kernels.sums_by(listed, offsets).astype(np.int64)),
                        pa.array(kernels.sums_by(logs, offsets)),
                        pa.array(kernels.sums_by(bits, by_text)),
                        pa.ListArray.from_arrays(pa.array(rare_before, pa.int32()), pa.array(hashes[~listed].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(later_before, pa.int32()), pa.array(distinct_grams[index[later]].view(np.int64))),
                    ],
                    names=["doc_id", "training", "n_tokens", "n_listed", "logs", "score", "rare", "later"],
                )

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = loaded()
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                column = batch.column("gram").slice(at, 1 << 14)
                grams = column.to_numpy().view(np.uint64)
                for k, d, keys in _keys(grams, depth):
                    missing = np.flatnonzero(cache["nodes"].find(keys) < 0)
                    if len(missing):
                        slots = np.full(len(missing), _slot(k, d, depth), np.int32)
                        yield pa.RecordBatch.from_arrays([column.take(pa.array(missing)), pa.array(slots), pa.array(keys[missing].view(np.int64))], names=["gram", "slot", "key"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = loaded()
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(at, 1 << 14)
                lists, rare = part.column("nodes"), {}
                place = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                slots, p, own = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                for slot in np.unique(slots):
                    here = slots == slot
                    rare[int(slot)] = place[here], p[here], own[here]
                bits, _ = _code_lengths(part.column("gram").to_numpy().view(np.uint64), cache, depth, rare)
                yield pa.RecordBatch.from_arrays([part.column("gram"), pa.array(bits)], names=["gram", "bits"])

    schema = "doc_id long, training boolean, n_tokens long, n_listed long, logs double, score double, rare array<long>, later array<long>"
    with small_batches(spark):
        texts = scratch.table(rows.mapInArrow(tidy(score), schema).withColumn("_row", F.monotonically_increasing_id()), "texts")
    # words that are not in the broadcast table: a word is rare, so no key of this join is hot
    rare = texts.select("_row", F.explode("rare").alias("key")).groupBy("_row", "key").agg(F.count("*").alias("_times"))
    rare = rare.join(words.where(F.col("n") < least), "key", "left") if least > 1 else rare.withColumn("n", F.lit(None).cast("long"))
    n = F.coalesce("n", F.lit(0))
    rare = rare.groupBy("_row").agg(
        F.sum(F.col("_times") * F.log10(n + 0.1)).alias("_logs"), F.sum(F.when(n > 0, F.col("_times")).otherwise(0)).alias("_known")
    )
    if least_node:
        # nodes that are not in the broadcast table: each distinct gram asks once for each, and all its texts get the result
        later = scratch.table(texts.select("_row", F.explode("later").alias("gram")).groupBy("_row", "gram").agg(F.count("*").alias("_times")), "later")
        grams = scratch.table(later.select("gram").distinct(), "grams")
        others = nodes.where(F.col("n") < least_node).select("key", "p1", "own")
        found = grams.mapInArrow(tidy(wanted), "gram long, slot int, key long").join(others, "key")
        found = found.groupBy("gram").agg(F.collect_list(F.struct("slot", "p1", "own")).alias("nodes"))  # at most 8 * (depth + 1)
        none = F.array().cast("array<struct<slot:int,p1:float,own:float>>")
        coded = grams.join(found, "gram", "left").select("gram", F.coalesce("nodes", none).alias("nodes"))
        coded = scratch.table(coded.mapInArrow(tidy(finish), "gram long, bits double"), "coded")
        given = later.join(coded, "gram").groupBy("_row").agg(F.sum(F.col("_times") * F.col("bits")).alias("_bits"))
        texts = texts.join(given, "_row", "left").withColumn("score", F.col("score") + F.coalesce("_bits", F.lit(0.0))).drop("_bits")
    ends = words.where(F.col("key") == END_WORD).agg(F.max("n")).first()[0] or 0  # training texts
    scale = math.log10(tokens + 0.1 * (distinct + 1))
    logs = F.col("logs") + F.coalesce("_logs", F.lit(0.0)) + math.log10(ends + 0.1)
    known = F.col("n_listed") + F.coalesce("_known", F.lit(0)) + (1 if ends else 0)
    return texts.drop("rare", "later").join(rare, "_row", "left").select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", known.cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * scale).alias("base_score"), "score",
    )


ship(__name__)
