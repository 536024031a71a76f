"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, found by diagonal run skipping.

At the current shift between the two arrays of token ends, probes of doubling length compare whole stretches, so that one
comparison passes many one-to-one tokens; a failed probe is halved down to the first difference. From there the arrays are walked to the
next common end, which gives one irregular group and the next shift. Tokens whose bytes overlap are linked; how many
documents hold a linked pair of ids is counted by Spark and looked up again for every document.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmart.llm import kernels
from salesmart.llm.tasks import ship, tidy, worker_cache
from salesmart.storage import Scratch

#: Pairs whose counts are broadcast (16 MB), the most frequent ones; all others reach their documents by a join.
MOST_PAIRS = 2**20
CHUNK_BYTES = 1 << 22
#: Texts are read in pieces of about so many characters, and blocks of pieces of about so many together.
PIECE_CHARS, BLOCK_CHARS = 1 << 18, 1 << 20
#: A worker keeps the alignment of the segments it met last, at least this many and at most twice as many.
SEGMENTS_KEPT, LONGEST_KEPT = 150_000, 64
# A single space between two characters that every engine takes for anything but space: no token of either kind crosses it.
_SOLID = "[!-~¡-ɏ‐-‧€]|[^\\W_]"
_CUT = re.compile(f"(?<={_SOLID}) (?={_SOLID})")
# Texts that may stand between two cuts.
_JOINS = re.compile(f"(?s)(?={_SOLID}).*(?<={_SOLID})\\Z")
# Characters on whose classes all regular expression engines agree; other texts go through the tokenizer itself.
_COMMON = re.compile("[\t\n\r\x20-\x7e¡-ɏ‐-‧€]*")
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def shown_bytes() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary, with their bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + n): byte for n, byte in enumerate(hidden)}


class ByteTokens:
    """The byte-level tokenizer: ids of a text, and the bytes of every id."""

    def __init__(self, tokenizer_json: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(tokenizer_json)
        self.whole.encode_special_tokens = True
        parts, shown = json.loads(tokenizer_json), shown_bytes()
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            self.bytes[at] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        self.quick, self.cuts = None, False
        first = parts.get("pre_tokenizer") or {}
        merges = [(pair if isinstance(pair, str) else " ".join(pair)).replace(" ", "") for pair in parts["model"].get("merges", [])]
        model = parts["model"]["vocab"]
        ordered = all(model[a] < model[b] for a, b in zip(merges, merges[1:]))
        plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        if plain and not parts.get("normalizer"):
            self.cuts = True
        if self.cuts and ordered:
            ranks = {bytes(shown[c] for c in token): at for token, at in model.items() if all(c in shown for c in token)}
            self.quick = tiktoken.Encoding("bytes", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.quick and _COMMON.fullmatch(text):
            return self.quick.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """The piece tokenizer: ids of texts (it puts a space before each itself), and the bytes of every id."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        self.bytes, self.cuts = [], True
        for at in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(at)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(at) else piece.replace("▁", " ").encode())
            # a text may be cut before a space only if no piece holds a space behind another character
            self.cuts &= "▁" not in piece.lstrip("▁")

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def pieces(text: str, limit: int) -> Iterator[str]:
    """Parts of a text that can be tokenised alone; the spaces at the cuts are left out, since each part gets one in front."""
    begin = 0
    while len(text) - begin > limit:
        cut = _CUT.search(text, begin + limit)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]


def stretches(ends_a: np.ndarray, ends_b: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Alternating (i, j, run, p, q): ``run`` one-to-one tokens from i and j, then an irregular group up to p and q
    (none where p equals i + run). Both arrays (32-bit) must end at the same byte."""
    whole_a, whole_b = ends_a.tobytes(), ends_b.tobytes()
    a, b = ends_a.tolist(), ends_b.tolist()
    n, m, i, j = len(a), len(b), 0, 0
    while i < n and j < m:
        left, run, step = min(n - i, m - j), 0, 1
        at_a, at_b = 4 * i, 4 * j
        while run < left:
            step = min(step, left - run)
            to = 4 * (run + step)
            if whole_a[at_a + 4 * run : at_a + to] != whole_b[at_b + 4 * run : at_b + to]:
                break
            run += step
            step *= 2
        else:
            step = 0
        while step > 1:
            step = (step + 1) // 2
            to = 4 * min(run + step, left)
            if whole_a[at_a + 4 * run : at_a + to] == whole_b[at_b + 4 * run : at_b + to]:
                run = min(run + step, left)
        p, q = i + run, j + run
        if p < n and q < m:
            while a[p] != b[q]:
                if a[p] < b[q]:
                    p += 1
                else:
                    q += 1
            p, q = p + 1, q + 1
        yield i, j, run, p, q
        i, j = p, q


class Aligner:
    """Aligns the tokens of whole texts; lives in a worker.

    A text is a row of segments that are tokenised alone. Each block's new segments are laid end to end and aligned in one
    run over their joint arrays of token ends; a segment's groups and links are then the same wherever it stands.
    """

    def __init__(self, tokenizer_json: str, model: bytes, kept: int = SEGMENTS_KEPT):
        self.a, self.b, self.kept = ByteTokens(tokenizer_json), PieceTokens(model), kept
        self.size_a, self.size_b = len(self.a.bytes), len(self.b.bytes)
        self.lengths_a = np.array([len(x) for x in self.a.bytes], np.uint32)
        self.lengths_b = np.array([len(x) for x in self.b.bytes], np.uint32)
        self.cuts = self.a.cuts and self.b.cuts
        self.recent, self.older = {}, {}

    def texts(self, texts: list[str | None], piece_chars: int = PIECE_CHARS, block_chars: int = BLOCK_CHARS) -> list[tuple]:
        """(n_a, n_b, n_groups, pairs, times, digest) of each text; zeros and '' where there are no tokens.

        ``pairs`` are the distinct linked pairs, a * size_b + b, in order, and ``times`` how often each is linked.
        """
        states = [State() for _ in texts]
        block, size = [], 0
        for state, text in zip(states, texts):
            for part in (pieces(text, piece_chars) if self.cuts else [text]) if text else ():
                block.append((state, part))
                size += len(part)
                if size >= block_chars:
                    self._block(block)
                    block, size = [], 0
        self._block(block)
        return [state.result() for state in states]

    def _block(self, block: list[tuple]) -> None:
        split = [(state, _CUT.split(part) if self.cuts else [part]) for state, part in block]
        wanted = {segment for _, segments in split for segment in segments}
        wanted.difference_update(self.recent)
        known = wanted & self.older.keys()
        self.recent.update((segment, self.older[segment]) for segment in known)
        new = sorted(wanted - known)
        self._learn(new)
        look_up = self.recent.__getitem__
        for state, segments in split:
            state.add([look_up(segment) for segment in segments])
        for segment in new:
            if len(segment) > LONGEST_KEPT:
                del self.recent[segment]
        if len(self.recent) > self.kept:
            self.recent, self.older = {}, self.recent

    def _learn(self, segments: list[str]) -> None:
        """Put (n_a, n_b, n_groups, groups, linked pairs) of each segment into the table, None where tokens lose bytes."""
        kept, all_a, all_b, sizes = [], [], [], []
        for run in self._runs(segments):
            text = " ".join(run)
            ids_a, (ids_b,), raw = self.a.ids(" " + text), self.b.ids([text]), (" " + text).encode()
            if b"".join(map(self.a.bytes.__getitem__, ids_a)) == raw and b"".join(map(self.b.bytes.__getitem__, ids_b)) == raw:
                kept += run
                sizes += [len(segment.encode()) + 1 for segment in run]
                all_a += ids_a
                all_b += ids_b
            elif len(run) == 1:
                self.recent[run[0]] = None
            else:
                for segment in run:
                    self._learn([segment])
        if not kept:
            return
        ends_a = np.cumsum(self.lengths_a[np.array(all_a, np.int64)], dtype=np.uint32)
        ends_b = np.cumsum(self.lengths_b[np.array(all_b, np.int64)], dtype=np.uint32)
        groups, last_a, links = self._groups(all_a, all_b, ends_a, ends_b)
        # every segment ends at a common end, so tokens, groups and links fall apart there
        ends = np.cumsum(sizes)
        at_a, at_b = (np.concatenate([[0], np.searchsorted(x, ends, side="right")]) for x in (ends_a, ends_b))
        group_at, link_at = np.searchsorted(last_a, at_a).tolist(), (8 * np.searchsorted(links[0], at_a)).tolist()
        pairs = np.array(all_a, np.int64)[links[0]] * self.size_b + np.array(all_b, np.int64)[links[1]]
        linked, counts = pairs.tobytes(), zip(np.diff(at_a).tolist(), np.diff(at_b).tolist())
        for n, (segment, (n_a, n_b)) in enumerate(zip(kept, counts)):
            begin, end = group_at[n], group_at[n + 1]
            self.recent[segment] = (n_a, n_b, end - begin, ";".join(groups[begin:end]), linked[link_at[n] : link_at[n + 1]])

    def _runs(self, segments: list[str], limit: int = 1 << 15) -> Iterator[list[str]]:
        """Segments that may be tokenised together, as if a text had been cut into them; the others alone."""
        run, size = [], 0
        for segment in segments:
            if not (self.cuts and _JOINS.match(segment) and _COMMON.fullmatch(segment)):
                yield [segment]
                continue
            run.append(segment)
            size += len(segment)
            if size > limit:
                yield run
                run, size = [], 0
        if run:
            yield run

    def _groups(self, ids_a: list[int], ids_b: list[int], ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[str], np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Groups as text, each group's last token of a, and the linked tokens' indexes."""
        a, b = ends_a.tolist(), ends_b.tolist()
        groups, last, linked_a, linked_b = [], [], [], []
        for i, j, run, p, q in stretches(ends_a, ends_b):
            if run:
                groups += [f"{x}|{y}" for x, y in zip(ids_a[i : i + run], ids_b[j : j + run])]
                last += range(i, i + run)
                linked_a += range(i, i + run)
                linked_b += range(j, j + run)
                i, j = i + run, j + run
            if i < p:
                groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
                last.append(p - 1)
                while i < p and j < q:  # neighbours overlap until both end together
                    linked_a.append(i)
                    linked_b.append(j)
                    if a[i] < b[j]:
                        i += 1
                    elif a[i] > b[j]:
                        j += 1
                    else:
                        i, j = i + 1, j + 1
        return groups, np.array(last, np.int64), (np.array(linked_a, np.int64), np.array(linked_b, np.int64))


class State:
    """What is known of one text while its pieces are read."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = 0
        self.whole, self.digest, self.pairs = True, hashlib.sha256(), []

    def add(self, records: list[tuple | None]) -> None:
        if not self.whole or None in records:
            self.whole = False
            return
        n_a, n_b, n_groups, groups, pairs = zip(*records)
        self.digest.update(((";" if self.n_groups else "") + ";".join(groups)).encode())
        self.n_a, self.n_b, self.n_groups = self.n_a + sum(n_a), self.n_b + sum(n_b), self.n_groups + sum(n_groups)
        self.pairs.append(np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True))

    def result(self) -> tuple:
        if not self.whole or not self.n_a:
            return 0, 0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64), ""
        pairs, times = self.pairs[0]
        if len(self.pairs) > 1:
            pairs, at = np.unique(np.concatenate([pairs for pairs, _ in self.pairs]), return_inverse=True)
            times = np.zeros(len(pairs), np.int64)
            np.add.at(times, at, np.concatenate([times for _, times in self.pairs]))
        return self.n_a, self.n_b, self.n_groups, pairs, times, self.digest.hexdigest()


def aligner(tokenizer_json: str, model: bytes) -> Aligner:
    """The worker's aligner for these two tokenizers."""
    cache = worker_cache(f"aligner-{zlib.crc32(tokenizer_json.encode())}-{zlib.crc32(model)}", large=True)
    if not cache:
        cache["aligner"] = Aligner(tokenizer_json, model)
    return cache["aligner"]


_LINKS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def linked(documents: DataFrame, tokenizer_json: str, model: bytes) -> DataFrame:
    """Per row its numbers of tokens, groups and links, the digest, and its distinct linked pairs with how often each is linked."""
    shipped = documents.sparkSession.sparkContext.broadcast((tokenizer_json, model))  # two vocabulary files

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*shipped.value)
        for batch in (part for whole in batches for part in kernels.chunks(whole, "text", CHUNK_BYTES)):
            rows = tool.texts(batch.column("text").to_pylist())
            n_a, n_b, n_groups, pairs, times, digests = zip(*rows) if rows else ([],) * 6
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in pairs])]), pa.int32())
            joined = [pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, [int(x.sum()) for x in times])],
                    pa.array(digests, pa.string()), *[pa.ListArray.from_arrays(offsets, x) for x in joined],
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(links), _LINKS)


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` pairs have it or more; 0 where all pairs are few enough."""
    if counts.count() <= most:
        return 0
    # one row per distinct count; the sum runs over at most the square root of twice all counted links
    per_count = counts.groupBy("n").agg(F.count("*").alias("pairs"))
    above, least = 0, None
    for row in per_count.orderBy(F.desc("n")).toLocalIterator():
        above += row.pairs
        if above > most:
            break
        least = row.n
    return least if least is not None else (1 << 62)


def align(documents: DataFrame, tokenizer_json: str, model: bytes, scratch: Scratch, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row of counts and the groups' digest for every row of ``documents``.

    Reads doc_id and text only. Null and empty texts, and texts whose tokens do not give back a space and the text, have no
    tokens: zeros and an empty digest. Repeated rows count as documents each, and each gets its row. An empty
    table gives no rows. Of pairs with the highest count of their first id, ties count all.

    Long texts are read in pieces; a text without a space between two words is one piece. Counts of the ``most_pairs`` most
    frequent pairs are broadcast, those of all others are joined to the documents that hold them.
    """
    spark = documents.sparkSession
    links = linked(documents, tokenizer_json, model).withColumn("_row", F.monotonically_increasing_id())
    links = scratch.table(links, "links")
    pair = F.explode("pairs").alias("pair")
    counts = scratch.table(links.select(pair).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    tool = Aligner(tokenizer_json, model)
    size_a, size_b = tool.size_a, tool.size_b
    best = np.zeros(size_a, np.int64)  # one number per id of the vocabulary
    for row in counts.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("n")).toLocalIterator():
        best[row.a] = row.n
    least = least_count(counts, most_pairs)
    frequent = counts.where(F.col("n") >= least).toArrow()
    keys = frequent.column("pair").to_numpy().astype(np.int64)
    order = np.argsort(keys)
    shipped = spark.sparkContext.broadcast((keys[order], frequent.column("n").to_numpy().astype(np.int64)[order], best))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, best = shipped.value
        for batch in batches:
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            pairs, times = (batch.column(name).flatten().to_numpy().astype(np.int64) for name in ("pairs", "times"))
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            n = np.where(found, numbers[at], 0) if len(known) else np.zeros(len(pairs), np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            count_sum, n_best = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(count_sum, row, times * n)
            np.add.at(n_best, row, np.where(found & (n == best[pairs // size_b]), times, 0))
            rest = np.flatnonzero(~found)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[rest], minlength=len(sizes)))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in _KEPT], pa.array(n_best), pa.array(count_sum),
                    *[pa.ListArray.from_arrays(offsets, pa.array(x[rest])) for x in (pairs, times)],
                ],
                names=[*_KEPT, "n_best", "count_sum", "rest", "rest_times"],
            )

    kinds = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'long'}" for name in _KEPT)
    scored = links.mapInArrow(tidy(look_up), f"{kinds}, n_best long, count_sum long, rest array<long>, rest_times array<long>")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if not least:
        return scored.select(*out)
    scored = scratch.table(scored, "scored")
    both = F.explode(F.arrays_zip(F.col("rest").alias("pair"), F.col("rest_times").alias("times"))).alias("_link")
    rest = scored.select("_row", both).select("_row", F.col("_link.pair").alias("pair"), F.col("_link.times").alias("times"))
    tops = spark.createDataFrame([(i, int(n)) for i, n in enumerate(best) if n], "a long, top long")
    rare = counts.where(F.col("n") < least).join(F.broadcast(tops), F.expr(f"pair div {size_b}") == F.col("a"))
    more = rest.join(rare, "pair").groupBy("_row").agg(
        F.sum(F.col("times") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("_best")
    )
    plus = lambda name, by: (F.col(name) + F.coalesce(by, F.lit(0))).alias(name)
    joined = scored.join(more, "_row", "left")
    return joined.select(*out[:5], plus("n_best", "_best"), plus("count_sum", "_sum"), "groups_sha256")


_KEPT = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

ship(__name__)
