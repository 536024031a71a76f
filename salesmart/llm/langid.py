"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes. After a context seen n times with q
different next bytes, a byte seen c times has probability c / (n + q), and q / (n + q) escapes to the context
one byte shorter; below the empty context all 256 bytes are equal. Trees come from a bounded sample
and are then frozen; the exact code length of the whole text under each tree decides, and the score is the
posterior probability of the shortest one (equal priors).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from salesmart.llm import kernels
from salesmart.llm.tasks import ship, small_batches, tidy, worker_cache
from salesmart.storage import Scratch

ORDER = 3
CHUNK_BYTES = 1 << 19
#: The trees are fitted on at most so many documents per language, those with the smallest hashes.
DOCUMENTS_PER_LANGUAGE = 1500
#: Counts of at most so many languages are broadcast (a row each).
MOST_LANGUAGES = 10_000
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def folded(text: Column) -> Column:
    return F.lower(text)


def sample(training: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE, most_broadcast: int = MOST_LANGUAGES) -> DataFrame:
    """At most ``per_language`` (lang, text) rows per language by hash of id and text; nulls are left out, repeated rows count once.

    Only texts of chosen rows are shuffled.
    """
    rows = training.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("_hash"))
    # hashes are spread evenly, so a threshold by count leaves few more than wanted before the ranking
    sizes = rows.groupBy("lang").count()
    few = sizes.limit(most_broadcast + 1).collect()
    share = (F.col("_hash") / float(1 << 64)) + 0.5
    wanted = share * F.col("count") < 2.0 * per_language + 20
    if len(few) <= most_broadcast:
        counts = rows.sparkSession.createDataFrame([tuple(row) for row in few], "lang string, count long")
        near = rows.join(F.broadcast(counts), "lang").where(wanted).drop("count")
    else:  # no table of languages to send: hashes meet their counts alone, and texts the chosen hashes
        chosen = rows.select("lang", "_hash").distinct().join(sizes, "lang").where(wanted).select("lang", "_hash")
        near = rows.join(chosen, ["lang", "_hash"], "left_semi")
    # a repeated row counts once, so that no task gets its copies
    near = near.groupBy("lang", "_hash").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "text"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= per_language).select("lang", "text")


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): counts of (order + 1)-byte grams; every text begins in a context of edge bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                texts = batch.filter(pa.array([x == lang for x in langs]))
                for part in kernels.chunks(texts, "text", CHUNK_BYTES):
                    buffer, starts, ends = kernels.joined(part.column("text"), order)
                    distinct, index = kernels.grams(buffer, _places(buffer, starts, ends, order), order + 1)
                    n = np.bincount(index, minlength=len(distinct))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(distinct), pa.string()), pa.array(distinct.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    counts = rows.select("lang", folded(F.col("text")).alias("text")).mapInArrow(tidy(count), "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _places(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    inside = np.ones(len(buffer), bool)
    for lead in range(1, order + 1):
        inside[starts - lead] = False
    inside[ends] = False
    return np.flatnonzero(inside)


def fit(counts: DataFrame, order: int = ORDER) -> dict:
    """The frozen trees: per context length, sorted grams and contexts with their code lengths by language.

    The table has at most languages x sampled bytes rows.
    """
    table = counts.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    lang = np.array([names.index(x) for x in table.column("lang").to_pylist()], np.int64)
    gram, n = table.column("gram").to_numpy().astype(np.uint64), table.column("n").to_numpy()
    levels = []
    for k in range(order + 1):  # context length
        mask = np.uint64((1 << (8 * (k + 1))) - 1)
        grams, at = np.unique(gram & mask, return_inverse=True)
        seen = np.zeros((len(grams), len(names)))
        np.add.at(seen, (at, lang), n)
        contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
        total, kinds = np.zeros((len(contexts), len(names))), np.zeros((len(contexts), len(names)))
        np.add.at(total, of, seen)
        np.add.at(kinds, of, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = np.log2(total[of] + kinds[of]) - np.log2(seen)
            escape = np.where(total > 0, np.log2(total + kinds) - np.log2(kinds), 0.0)
        levels.append({"grams": grams, "found": np.where(seen > 0, found, np.inf).astype(np.float32), "contexts": contexts, "escape": escape.astype(np.float32)})
    return {"names": names, "levels": levels}


def code_lengths(grams: np.ndarray, model: dict) -> np.ndarray:
    """Bits of the last byte of each gram under every language."""
    bits = np.full((len(grams), len(model["names"])), 8.0, np.float32)
    for k, level in enumerate(model["levels"]):
        short = grams & np.uint64((1 << (8 * (k + 1))) - 1)
        at = level["lookup"].find(short)
        context = level["context_lookup"].find(short >> np.uint64(8))
        found, escape = level["found"][at], level["escape"][context]
        bits = np.where(np.isfinite(found), found, escape + bits)
    return bits


def _prepared(model: dict) -> dict:
    """Lookups for a model; unknown grams and contexts read the last row: not found, no escape."""
    levels = []
    for level in model["levels"]:
        grams, found = kernels.in_order(level["grams"], level["found"])
        contexts, escape = kernels.in_order(level["contexts"], level["escape"])
        found[-1] = np.inf
        levels.append({"lookup": kernels.Lookup(grams, 16), "found": found, "context_lookup": kernels.Lookup(contexts, 16), "escape": escape})
    return {"names": model["names"], "levels": levels}


def predictor(spark, training: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE):
    """Fit on ``training`` (doc_id, lang, text) and return a function that adds lang_pred and score to texts."""
    with small_batches(spark):
        model = fit(gram_counts(sample(training.select("doc_id", "lang", "text"), per_language)))
    shipped = spark.sparkContext.broadcast(model)
    token = uuid.uuid4().hex

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("langid", large=True)
        if cache.get("token") != token:
            cache.clear()
            cache |= {"token": token, "model": _prepared(shipped.value)}
        trees = cache["model"]
        names = np.array([*trees["names"], UNKNOWN], object)
        for batch in batches:
            for part in kernels.chunks(batch, "_folded", CHUNK_BYTES):
                best, score = np.full(part.num_rows, len(names) - 1), np.zeros(part.num_rows)
                if len(names) > 1:
                    buffer, starts, ends = kernels.joined(part.column("_folded"), ORDER)
                    places = _places(buffer, starts, ends, ORDER)
                    offsets = kernels.by_text(places, starts)
                    distinct, index = kernels.grams(buffer, places, ORDER + 1)
                    table = code_lengths(distinct, trees)
                    totals = np.stack([kernels.sums_by(table[:, j][index], offsets) for j in range(len(names) - 1)], axis=1)
                    letters = part.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
                    shortest = totals.argmin(axis=1)  # the first name among equals
                    gap = np.minimum(totals - totals.min(axis=1, keepdims=True), 1000.0)
                    best = np.where(letters, shortest, best)
                    score = np.where(letters, 1 / np.exp2(-gap).sum(axis=1), 0.0)
                keep = [name for name in part.schema.names if name not in ("_folded", "_letters")]
                yield pa.RecordBatch.from_arrays([*[part.column(name) for name in keep], pa.array(names[best], pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    def predicted(rows: DataFrame) -> DataFrame:
        """``rows`` hold ``text`` and columns to carry; the text is replaced by lang_pred and score."""
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        carried = [name for name in rows.columns if name != "text"]
        asked = rows.select(*carried, folded(text).alias("_folded"), text.rlike(r"\p{L}").alias("_letters"))
        fields = [field for field in rows.schema.fields if field.name != "text"]
        added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
        return asked.mapInArrow(tidy(predict), T.StructType([*fields, *added]))

    return predicted


ship(__name__)


def identify(documents: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``documents``; reads doc_id, text and lang only.

    Trees learn from rows that are not held out and have a language; lang plays no part in a prediction.
    A null text or one without letters is ``und`` with score 0, and so is every text when there is no language to
    learn. Equal code lengths go to the first language name. Repeated rows get equal results. An empty table gives no rows;
    other columns play no part.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    predicted = predictor(documents.sparkSession, rows.where(~held_out(F.col("doc_id"))), per_language)
    return predicted(rows.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")))


def kept_documents(documents: DataFrame, scratch: Scratch, least_score: float = 0.5, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """The rows of ``documents`` whose language is told with at least ``least_score``, with all their columns.

    They are written here, since small Arrow batches hold only for what runs meanwhile: each row carries its text twice.
    """
    training = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    predicted = predictor(documents.sparkSession, training.where(~held_out(F.col("doc_id"))), per_language)
    whole = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_document")
    kept = predicted(documents.select(whole, "text")).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("_document.*")
    with small_batches(documents.sparkSession):
        return scratch.table(kept, "kept")
