"""NumPy helpers for byte and word streams of whole batches; they run inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from salesmart.llm.tasks import ship, worker_cache

EDGE = 0xFF  # never a byte of UTF-8
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13, EDGE]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def chunks(batch: pa.RecordBatch, column: str, limit: int):
    """Slices of a batch whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = 0
    while begin < len(sizes):
        end = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def joined(texts: pa.Array, lead: int, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array (with ``fold``, A-Z lower-cased), each between ``lead`` edge bytes and one more.

    Returns the bytes, where each text begins, and where it ends (the place of its last edge byte).
    """
    values = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
    sizes = np.array([len(x) for x in values], np.int64)
    head, tail = bytes([EDGE]) * lead, bytes([EDGE])
    buffer = np.frombuffer(b"".join(piece for value in values for piece in (head, value, tail)), np.uint8)
    buffer = LOWER[buffer] if fold else buffer
    starts = np.cumsum(sizes + lead + 1) - sizes - 1
    return buffer, starts, starts + sizes


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache("powers")
    if len(cache.get("up", ())) < n:
        size = ((int(n) >> 16) + 1) << 16
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            cache[name] = np.cumprod(steps, dtype=np.uint64)
    return cache["up"], cache["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``buffer`` begins, and its 64-bit hash."""
    space = IS_SPACE[buffer]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buffer) and not space[0]:
        edges = np.concatenate([[0], edges])
    if len(edges) % 2:
        edges = np.concatenate([edges, [len(buffer)]])
    begin, end = edges[0::2], edges[1::2]
    up, down = _powers(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=sums[1:])
    return begin, mixed((sums[end] - sums[begin]) * down[begin])


def by_text(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Offsets into ``places`` at which each text's part begins, with the end of the last one."""
    return np.concatenate([np.searchsorted(places, starts), [len(places)]]).astype(np.int64)


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; empty parts give 0."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def grams(buffer: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-byte grams (first byte highest) and, for each end place, the index of its gram.

    Prefixes are numbered one byte at a time in dense tables, which needs no sorting; if a table would grow
    past 32M entries (texts with very many distinct grams) the codes are sorted instead.
    """
    first = ends - (width - 1)
    code = (buffer[first].astype(np.int64) << 8) | buffer[first + 1] if width > 1 else buffer[first].astype(np.int64)
    distinct = None
    for k in range(2, width + 1):
        if distinct is not None:
            code = (rank[code].astype(np.int64) << 8) | buffer[first + k - 1]  # noqa: F821
        size = 65_536 if distinct is None else len(distinct) << 8
        if size > 1 << 25:
            full = np.zeros(len(ends), np.uint64)
            for j in range(width):
                full = (full << np.uint64(8)) | buffer[first + j]
            return np.unique(full, return_inverse=True)
        seen = np.zeros(size, bool)
        seen[code] = True
        present = np.flatnonzero(seen)
        rank = np.zeros(size, np.int32)
        rank[present] = np.arange(len(present), dtype=np.int32)
        if distinct is None:
            distinct = present.astype(np.uint64)
        else:
            distinct = (distinct[present >> 8] << np.uint64(8)) | (present & 255).astype(np.uint64)
    return distinct, rank[code]


class Lookup:
    """Places of 64-bit keys, found by direct index on the leading bits of the mixed key.

    ``keys`` are mixed and sorted, as ``in_order`` leaves them.
    """

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        heads = np.arange((1 << bits) + 1, dtype=np.uint64)
        self.starts = np.searchsorted(keys, heads[:-1] << self.shift)
        self.starts = np.concatenate([self.starts, [len(keys)]]).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each (unmixed) key, or -1."""
        wanted = mixed(keys.astype(np.uint64))
        head = (wanted >> self.shift).astype(np.int64)
        place, end = self.starts[head], self.starts[head + 1]
        found = np.full(len(keys), -1, np.int32)
        open_ = np.flatnonzero(place < end)
        while len(open_):
            hit = self.keys[place[open_]] == wanted[open_]
            found[open_[hit]] = place[open_[hit]]
            open_ = open_[~hit]
            place[open_] += 1
            open_ = open_[place[open_] < end[open_]]
        return found


def in_order(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Mixed keys in order for a ``Lookup``, and the values that go with them, with a zero at place -1."""
    hashes = mixed(keys.astype(np.uint64))
    order = np.argsort(hashes)
    return [hashes[order], *[np.concatenate([value[order], np.zeros((1, *value.shape[1:]), value.dtype)]) for value in values]]


ship(__name__)
