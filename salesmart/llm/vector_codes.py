"""Vector codes: product quantisation whose assignments keep Drake-Hamerly adaptive bounds between passes.

A vector's components become integers, its equal parts get the index of the nearest entry of the part's codebook.
Every part keeps its ``b`` nearest entries, ordered lower bounds of the distances to all but the assigned one, and one
outer bound for all entries beyond them. Entries that move lower the bounds by as much; only where a bound no longer
shows the assigned entry to be the nearest are distances worked out again, of the first entries or, beyond the outer
bound, of all. ``b`` follows from how many entries the pass before needed. All decisions compare integers, so codes are those of
a search through all entries.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.tasks import ship, tidy
from salesmart.operators.lookups import attach
from salesmart.storage import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components are kept within this bound, so that a vector's error fits 64 bits; it is reached by values beyond 524,288.
LARGEST = 1 << 27
#: Bounds are stored in eighths, as 16-bit numbers; a larger bound is lowered to the largest, which is a bound as well.
_EIGHTHS, _TOP = 8, 65_535
_CHUNK = 1 << 18
_ROW, _CELL, _DEPTH = 0, 1, 2
_STATE = "kind int, vec_id long, label string, x array<int>, near binary, low binary, error long, cell long, value long"


def whole_components(embeddings: DataFrame) -> DataFrame:
    """vec_id, label as text and integer components of the rows whose vector is whole and finite."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    bounded = lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")
    label = F.when(F.col("label").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    return embeddings.where(vector.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform(vector, bounded).alias("x")
    )


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances, (rows, entries), of integer parts to all entries."""
    total = np.zeros((len(x), len(book)), np.int64)
    for j in range(x.shape[1]):
        step = x[:, j, None] - book[None, :, j]
        total += step * step
    return total


def lower(squared: np.ndarray) -> np.ndarray:
    """The largest stored bound that is not above the distance."""
    squared = np.minimum(squared, _TOP * _TOP // 64 + 1) * (_EIGHTHS * _EIGHTHS)
    return np.minimum(np.floor(np.sqrt(squared.astype(np.float64))), _TOP).astype(np.int64)


def nearest(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Search through all entries: the b nearest (ties to the lower index), bounds of all but the first and of the rest,
    and the squared distance of the first."""
    squared = distances(x, book)
    order = np.argsort(squared, axis=1, kind="stable")
    ranked = np.take_along_axis(squared, order[:, : b + 1], 1)
    low = lower(ranked[:, 1:])
    if low.shape[1] < b:  # no entry is left beyond the nearest ones
        low = np.concatenate([low, np.full((len(x), b - low.shape[1]), _TOP)], 1)
    return order[:, :b], low, ranked[:, 0]


def moved_bounds(near: np.ndarray, low: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Bounds after the entries moved by ``drift``, ordered again: none is above the next."""
    outer = low[:, -1:] - drift.max()
    inner = low[:, :-1] - drift[near[:, 1:]]
    both = np.maximum(np.concatenate([inner, outer], 1), 0)
    return np.minimum.accumulate(both[:, ::-1], axis=1)[:, ::-1]


def reassign(x: np.ndarray, book: np.ndarray, drift: np.ndarray, near: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Assign one part position again from its bounds.

    Returns near entries, bounds, the squared distance of the first, and how many entries each row needed (1: the bounds alone
    decided; one more than are kept: all).
    """
    b = near.shape[1]
    near, low = near.astype(np.int64), moved_bounds(near, low, drift)
    step = x - book[near[:, 0]]
    first = (step * step).sum(1)
    # the first bound that lies above the assigned entry's distance: entries from there on are farther
    above = (first[:, None] < (_TOP * _TOP) // 64) & (first[:, None] * (_EIGHTHS * _EIGHTHS) < low * low)
    needed = np.where(above.any(1), above.argmax(1) + 1, b + 1)
    for z in np.unique(needed):
        rows = np.flatnonzero(needed == z)
        if z == 1:
            continue
        if z > b:
            near[rows], low[rows], first[rows] = nearest(x[rows], book, b)
            continue
        some = near[rows, :z]
        step = x[rows, None, :] - book[some]
        squared = (step * step).sum(2)
        order = np.lexsort((some, squared), axis=1)
        squared = np.take_along_axis(squared, order, 1)
        near[rows, :z], first[rows] = np.take_along_axis(some, order, 1), squared[:, 0]
        # entry j of the sorted ones is bounded by its own distance, and all later ones by theirs
        low[rows, : z - 1] = np.minimum(lower(squared[:, 1:]), low[rows, z - 1 : z])
    return near, low, first, needed


def _arrays(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), PARTS, width)


def _assign_pass(books: np.ndarray, drift: np.ndarray | None, b_from: int, b: int, with_sums: bool):
    """A batch function that assigns every part, from its bounds where there are some, and sums parts by entry."""
    width = books.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = books.shape[1]
        counts, sums = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, width), np.int64)
        depths = np.zeros(b_from + 2, np.int64)
        step = max(1, _CHUNK // max(PARTS * width, 64))
        for batch in (whole.slice(at, step) for whole in batches for at in range(0, len(whole), step)):
            n = len(batch)
            x = _arrays(batch, width)
            near_all, low_all = np.zeros((n, PARTS, b), np.uint8), np.zeros((n, PARTS, b), np.uint16)
            error = np.zeros(n, np.int64)
            if drift is not None:
                old_near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(n, PARTS, b_from)
                old_low = np.frombuffer(b"".join(batch.column("low").to_pylist()), "<u2").reshape(n, PARTS, b_from).astype(np.int64)
            for p in range(PARTS):
                if drift is None:
                    near, low, first = nearest(x[:, p], books[p], b)
                else:
                    near, low, first, needed = reassign(x[:, p], books[p], drift[p], old_near[:, p], old_low[:, p])
                    depths += np.bincount(needed, minlength=b_from + 2)
                    # entries beyond the b kept are bounded by the first bound left out
                    near, low = near[:, :b], low[:, :b]
                near_all[:, p], low_all[:, p] = near, low
                error += first
                if with_sums:
                    counts[p] += np.bincount(near[:, 0], minlength=k)
                    np.add.at(sums[p], near[:, 0], x[:, p])
            yield _rows(n, batch, near_all, low_all, error)
        if with_sums:
            yield _cells(_CELL, np.concatenate([counts[:, :, None], sums], 2).ravel())
            yield _cells(_DEPTH, depths)

    return assign


def _rows(n: int, batch: pa.RecordBatch, near: np.ndarray, low: np.ndarray, error: np.ndarray) -> pa.RecordBatch:
    pack = lambda array: pa.array([row.tobytes() for row in array], pa.binary())
    nothing = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, _ROW, np.int32)), batch.column("vec_id"), batch.column("label"), batch.column("x").cast(pa.list_(pa.int32())),
            pack(near), pack(low.astype("<u2")), pa.array(error), nothing, nothing,
        ],
        names=["kind", "vec_id", "label", "x", "near", "low", "error", "cell", "value"],
    )


def _cells(kind: int, values: np.ndarray) -> pa.RecordBatch:
    """One row per number that is not 0; they are summed over all tasks."""
    at = np.flatnonzero(values)
    n = len(at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int32())),
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array(at.astype(np.int64)), pa.array(values[at]),
        ],
        names=["kind", "vec_id", "label", "x", "near", "low", "error", "cell", "value"],
    )


def _summed(state: DataFrame, kind: int, size: int) -> np.ndarray:
    """Sums of a pass by cell: a number of rows that the codebooks' size bounds."""
    out = np.zeros(size, np.int64)
    for row in state.where(F.col("kind") == kind).groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row.cell] = row.value
    return out


def next_depth(depths: np.ndarray, b: int) -> int:
    """Entries to keep for the next pass: enough for 99 of 100 parts that fewer than all entries decided."""
    within = np.cumsum(depths[: b + 1])
    if not within[-1]:
        return b
    return max(2, int(np.searchsorted(within, 0.99 * within[-1])))


def first_books(kept: DataFrame) -> np.ndarray:
    """(part, entry, position): the parts of the rows with the smallest ids; ties go by components."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).select("x").collect()
    x = np.array([row.x for row in rows], np.int64)
    return x.reshape(len(rows), PARTS, -1).transpose(1, 0, 2).copy()


def moved(books: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries replaced by the floored means of their parts (unused ones stay), and how far each moved, in eighths, rounded up."""
    parts, k, width = books.shape
    table = cells.reshape(parts, k, width + 1)
    counts, sums = table[:, :, :1], table[:, :, 1:]
    fresh = np.where(counts > 0, np.floor_divide(sums, np.maximum(counts, 1)), books)
    squared = ((fresh - books) ** 2).sum(2)
    drift = np.array([[math.isqrt(int(d) * _EIGHTHS * _EIGHTHS) + 1 if d else 0 for d in row] for row in squared], np.int64)
    return fresh, drift


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(embeddings: DataFrame, scratch: Scratch) -> DataFrame:
    """vec_id, code, error, label_error and the codebooks' digest for every row with a whole, finite vector.

    Rows whose vector is null or holds a null, NaN or infinity go. Vectors must have one length; where they do not, the
    commonest length counts (of equally common ones the longer) and the others go. A length that 16 does not divide is
    filled up with zeros, which add nothing to any distance. With fewer than 64 rows there are as many entries. Components
    are held within 2**27. Repeated rows are coded each; rows with one id are told apart by their components. A null vec_id
    comes last among the first 64. An empty table, or one without a whole vector, gives no rows. Other columns play no part.
    """
    kept = whole_components(embeddings)
    sizes = kept.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("width")).first()
    columns = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    spark = embeddings.sparkSession
    if common is None:
        return spark.createDataFrame([], columns)
    width = -(-common.width // PARTS)
    filled = F.concat("x", F.array_repeat(F.lit(0), PARTS * width - common.width))
    kept = kept.where(F.size("x") == common.width).withColumn("x", filled)
    books = first_books(kept)
    k = books.shape[1]
    b = b_from = max(2, min(k // 8, 255)) if k > 1 else 1
    state, drift = kept, None
    for turn in range(ROUNDS):
        state = scratch.table(state.mapInArrow(tidy(_assign_pass(books, drift, b_from, b, True)), _STATE), f"round-{turn}")
        cells = _summed(state, _CELL, PARTS * k * (width + 1))
        depths = _summed(state, _DEPTH, b_from + 2)
        books, drift = moved(books, cells)
        b_from, b = b, min(b, next_depth(depths, b_from)) if turn else b
        state = state.where(F.col("kind") == _ROW)
    final = state.mapInArrow(tidy(_assign_pass(books, drift, b_from, b, False)), _STATE)
    codes = F.lower(F.hex(F.col("near")))
    # the assigned entry of every part is the first of its b
    code = F.concat(*[F.substring(codes, 2 * b * p + 1, 2) for p in range(PARTS)])
    coded = scratch.table(final.select("vec_id", "label", code.alias("code"), "error"), "coded")
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows"))
    rows = attach(coded, per_label, "label", "_rows", "vec_id", scratch)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same by searching all entries, for DuckDB."""
    books = ["b0 AS (SELECT p, rn - 1 AS e, part FROM parts WHERE rn <= 64)"]
    for turn in range(ROUNDS + 1):
        books.append(
            f"d{turn} AS (SELECT q.rn, q.p, min(list_sum([(q.part[j] - b.part[j]) * (q.part[j] - b.part[j]) for j in range(1, len(q.part) + 1)])::BIGINT * 64 + b.e) AS best "
            f"FROM parts q JOIN b{turn} b USING (p) GROUP BY q.rn, q.p)"
        )
        if turn < ROUNDS:
            books.append(
                f"s{turn} AS (SELECT p, e, list(floor_mean ORDER BY j) AS part FROM (SELECT p, best % 64 AS e, j, "
                f"(sum(part[j])::BIGINT - ((sum(part[j])::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean "
                f"FROM d{turn} JOIN parts USING (rn, p), (SELECT unnest(range(1, (SELECT max(len(part)) FROM parts) + 1)) AS j) GROUP BY p, e, j) GROUP BY p, e)"
            )
            books.append(f"b{turn + 1} AS (SELECT b.p, b.e, coalesce(s.part, b.part) AS part FROM b{turn} b LEFT JOIN s{turn} s USING (p, e))")
    last = ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn,
    [floor(x::DOUBLE * 256)::BIGINT for x in embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
  SELECT rn, p, x[p * (len(x) // 16) + 1 : (p + 1) * (len(x) // 16)] AS part FROM kept, (SELECT unnest(range(16)) AS p)
), {", ".join(books)},
coded AS (
  SELECT rn, string_agg(lpad(to_hex(best % 64), 2, '0'), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM d{last} GROUP BY rn
), entries AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{last})
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rn), entries
"""


SQL = _sql()

ship(__name__)
