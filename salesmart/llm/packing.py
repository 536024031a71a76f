"""Packing token sequences by deficit round-robin over source queues.

Every source is a queue of its documents' tokens, served in blocks of ``UNIT`` tokens: whole units of a document, and
blocks joined from what is left of its documents, fewer than ``UNIT`` tokens each, spread evenly among them. The j-th block of
a source is due at (j + 1/2) / share, the moment at which the source has been owed half of it; serving
all blocks in the order in which they are due is deficit round-robin with every deficit carried over, and it needs
no running state: the due times alone give each block its place, whatever the partitions. The last tokens of a
source, fewer than a block, are due likewise and share blocks with those of other sources. A sequence
holds a whole number of blocks, so only the last sequence of all has padding.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm import kernels
from salesmart.llm.tasks import release, ship, small_batches, tidy, worker_cache
from salesmart.operators.lookups import is_small
from salesmart.storage import Scratch

SEQUENCE = 2048
UNIT = 256
END_ID = 1
#: A worker's table of words, and the longest word it keeps.
WORDS_KEPT, LONGEST_KEPT = 140_000, 64
CHUNK_BYTES = 2 << 20

# Letters and digits up to Latin Extended-A. Texts within this range are split here and their words are
# looked up; all other texts go through the tokenizer whole.
_LETTERS = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\u00a1-\u017f]*")
# letters first: no other kind of piece begins with one
_PIECE = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_LETTERS}{_DIGITS}]+")


class Words(dict):
    """Token ids of what stands between white space and of its pieces, as packed unsigned 32-bit integers, worked out on first use.

    What was met last stays: a full table becomes the older one, from which words that come again are taken back.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.model, self.older = tokenizer.model, {}
        # the usual reversible map of bytes to printable characters
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [byte for byte in range(256) if byte not in shown]
        self.shown = {byte: byte for byte in shown} | {byte: 256 + n for n, byte in enumerate(hidden)}

    def piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()  # shown as they are
        letters = piece if plain else piece.encode().decode("latin-1").translate(self.shown)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            pieces = [word] if word.isalpha() else _PIECE.findall(word)
            ids = self.piece(word) if len(pieces) == 1 else b"".join(map(self.__getitem__, pieces))
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def encoder(tokenizer_json: str):
    """A function from text to packed ids, equal to the tokenizer's own on every text."""
    from tokenizers import Tokenizer

    cache = worker_cache(f"words-{zlib.crc32(tokenizer_json.encode())}", large=True)
    if not cache:
        tokenizer = Tokenizer.from_str(tokenizer_json)
        tokenizer.encode_special_tokens = True
        cache |= {"tokenizer": tokenizer, "words": Words(tokenizer), "by_word": splits_like_piece(tokenizer_json)}
        release()  # what reading the vocabulary took
    tokenizer, by_word, look_up = cache["tokenizer"], cache["by_word"], cache["words"].__getitem__

    def encode(text: str) -> bytes:
        if by_word and _PLAIN.fullmatch(text):
            return b"".join(map(look_up, text.lower().split()))
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    return encode


def splits_like_piece(tokenizer_json: str) -> bool:
    """Whether the tokenizer composes, lower-cases and splits as ``_PIECE`` does, so that words can be looked up."""
    parts = json.loads(tokenizer_json)
    steps = [step.get("type") for step in (parts.get("normalizer") or {}).get("normalizers", [])]
    splits = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and splits[0].get("pattern", {}).get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        and [split.get("type") for split in splits] == ["Split", "ByteLevel"]
        and parts["model"]["type"] == "BPE"
    )


def tokenized(documents: DataFrame, tokenizer_json: str, unit: int = UNIT) -> DataFrame:
    """Per row: doc_id, source, doc_tokens (with the end id), crcs of its whole units, and the rest's ids."""
    shipped = documents.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shipped.value)
        end, step = array("I", [END_ID]).tobytes(), 4 * unit
        for batch in (part for whole in batches for part in kernels.chunks(whole, "text", CHUNK_BYTES)):
            sizes, crcs, rests = [], [], []
            for text in batch.column("text").to_pylist():
                ids = encode(text or "") + end
                whole = len(ids) // step * step
                sizes.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[at : at + step]) for at in range(0, whole, step)])
                rests.append(ids[whole:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())],
                names=["doc_id", "source", "doc_tokens", "crcs", "rest"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(tokens), "doc_id long, source string, doc_tokens long, crcs array<long>, rest binary")


ship(__name__)


def running(df: DataFrame, group: list[str], order: list[str], values: dict[str, Column], scratch: Scratch, name: str) -> DataFrame:
    """Add, for each of ``values``, its sum over the rows before in ``order`` within ``group``.

    The rows are range-partitioned over group and order and written; sums per written partition (a few
    rows each) give the start of every partition, so neither a hot group nor the whole goes through one task.
    """
    placed = scratch.table(df.orderBy(*group, *order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("_at", 33)
    keys = [F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")).alias(f"_key{i}") for i, g in enumerate(group)]
    names = [f"_key{i}" for i in range(len(group))]
    placed = placed.select("*", *keys, part.alias("_part"))
    sums = placed.groupBy("_part", *names).agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    before = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", *names, *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in values])
    starts = scratch.table(starts, f"{name}-starts")
    starts = F.broadcast(starts) if is_small(starts) else starts
    here = Window.partitionBy("_part", *names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumns({n: F.coalesce(F.sum(v).over(here), F.lit(0)) for n, v in values.items()})
    joined = inside.join(starts, ["_part", *names])
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_start_{n}")).alias(n) for n in values])


def pack(
    documents: DataFrame,
    tokenizer_json: str,
    scratch: Scratch,
    shares: dict[str | None, float] | None = None,
    sequence: int = SEQUENCE,
    unit: int = UNIT,
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, and the CRC-32 of its ids.

    ``shares`` are the wanted token shares of the sources (null among them); by default each source has
    its own share of all tokens. A source not named there has share 1. When a source runs dry the rest go on.

    Reads doc_id, source and text only. A null or empty text is the end id alone; repeated rows are packed
    each; rows of one doc_id stay apart by their own pieces; an empty table gives no rows.
    """
    if sequence % unit:
        raise ValueError("a sequence must hold a whole number of units")
    with small_batches(documents.sparkSession):
        docs = scratch.table(tokenized(documents, tokenizer_json, unit).withColumn("_row", F.monotonically_increasing_id()), "tokens")
    docs = docs.select("*", F.size("crcs").cast("long").alias("units"), (F.octet_length("rest") / 4).cast("long").alias("left"))
    queued = running(docs, ["source"], ["doc_id", "_row"], {"first_unit": F.col("units"), "first_left": F.col("left")}, scratch, "queues")
    share = F.lit(1.0)
    for source, value in (shares or {}).items():
        share = F.when(F.col("source").eqNullSafe(F.lit(source)), float(value)).otherwise(share)
    key = lambda name: F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))
    totals = docs.groupBy("source").agg(F.sum("units").alias("_units"), F.sum("left").alias("_left"))
    totals = totals.select(
        key("source").alias("_source"), "_units", F.floor(F.col("_left") / unit).alias("_rests"), F.pmod("_left", F.lit(unit)).alias("_tail"),
        (F.col("_units") * unit + F.col("_left") if shares is None else share).cast("double").alias("_share"),
    )
    totals = scratch.table(totals, "totals")
    # the last tokens of all sources in the order in which they are due, joined to blocks, too
    due = ((F.col("_units") + F.col("_rests")) * unit + F.col("_tail") / 2) / F.col("_share")
    tails = running(totals.select("_source", "_tail", due.alias("_tail_due")), [], ["_tail_due", "_source"], {"_tail_at": F.col("_tail")}, scratch, "tails")
    tails = scratch.table(tails.select("_source", "_tail_at", "_tail_due", "_tail"), "tail-places")
    all_tails = tails.agg(F.sum("_tail")).first()[0] or 0
    parts = F.explode(F.sequence(F.floor(F.col("_tail_at") / unit), F.floor((F.col("_tail_at") + F.col("_tail") - 1) / unit)))
    mixed = scratch.table(tails.where("_tail > 0").select(parts.alias("_number"), "_tail_due").groupBy("_number").agg(F.min("_tail_due").alias("_block_due")), "mixed")
    totals = totals.join(tails.select("_source", "_tail_at"), "_source")
    totals = F.broadcast(totals) if is_small(tails) else totals
    queued = queued.withColumn("_source", key("source")).join(totals, "_source")

    # places of units (kind 0) and of joined blocks (kind 1) in one queue, merged evenly; exact in whole numbers
    wide = lambda x: f"CAST({x} AS DECIMAL(19, 0))"
    rests_before = F.expr(f"CASE WHEN _units = 0 THEN 0L ELSE ((2 * {wide('_number')} + 1) * {wide('_rests')} + _units - 1) DIV (2 * {wide('_units')}) END")
    units_before = F.expr(f"CASE WHEN _rests = 0 THEN _units ELSE ((2 * {wide('_number')} + 1) * {wide('_units')} + _rests) DIV (2 * {wide('_rests')}) END")
    when = lambda before: (F.col("_number") + before + 0.5) * unit / F.col("_share")
    names = ["doc_id", "source", "_row", "doc_tokens", "start", "length", "ids_crc32", "_due", "_kind", "_source", "_number", "_in"]
    units = queued.select("doc_id", "source", "_row", "doc_tokens", "_source", "first_unit", "_units", "_rests", "_share", F.posexplode("crcs").alias("_k", "ids_crc32"))
    units = units.withColumn("_number", F.col("first_unit") + F.col("_k")).withColumns({
        "start": (F.col("_k") * unit).cast("long"), "length": F.lit(unit).cast("long"), "_due": when(rests_before), "_kind": F.lit(0), "_in": F.lit(0).cast("long"),
    }).select(*names)

    def cut(rows: DataFrame) -> DataFrame:
        """Pieces of rests (_from to _to, ``rest`` from _skip on) in blocks of ``unit``: _number, _in, start, length, ids_crc32."""
        rows = rows.withColumn("_number", F.explode(F.sequence(F.floor(F.col("_from") / unit), F.floor((F.col("_to") - 1) / unit))))
        begin = F.greatest("_from", F.col("_number") * unit)
        rows = rows.withColumn("_begin", begin).withColumn("length", F.least("_to", (F.col("_number") + 1) * unit) - F.col("_begin"))
        skip = F.col("_skip") + F.col("_begin") - F.col("_from")
        ids = F.substring("rest", (skip * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
        return rows.withColumns({"_in": F.col("_begin") - F.col("_number") * unit, "start": F.col("doc_tokens") - F.col("left") + skip, "ids_crc32": F.crc32(ids)})

    rest = queued.where("left > 0").withColumn("_end", F.col("first_left") + F.col("left")).withColumn("_whole", F.col("_rests") * unit)
    inside = rest.where("first_left < _whole").withColumns({"_from": F.col("first_left"), "_to": F.least("_end", "_whole"), "_skip": F.lit(0).cast("long")})
    inside = cut(inside).withColumns({"_due": when(units_before), "_kind": F.lit(1)}).select(*names)
    last = rest.where("_end > _whole").withColumn("_first", F.greatest("first_left", "_whole"))
    shift = F.col("_tail_at") - F.col("_whole")
    last = cut(last.withColumns({"_from": F.col("_first") + shift, "_to": F.col("_end") + shift, "_skip": F.col("_first") - F.col("first_left")}))
    last = last.join(F.broadcast(mixed) if is_small(mixed) else mixed, "_number")
    # the very last block may be short and follows all others
    full = (F.col("_number") + 1) * unit <= all_tails
    last = last.withColumns({"_due": F.when(full, F.col("_block_due")).otherwise(float("inf")), "_kind": F.lit(2), "_source": F.lit("")}).select(*names)

    pieces = units.unionByName(inside).unionByName(last)
    pieces = running(pieces, [], ["_due", "_kind", "_source", "_number", "_in"], {"_place": F.col("length")}, scratch, "pieces")
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.floor(F.col("_place") / sequence).alias("sequence_id"), F.pmod("_place", F.lit(sequence)).alias("offset"), "source",
    )
