"""Vector codes against SQL and a full search, token alignment against a walk over all bytes, main text against markup and new layouts."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import connect, difference
from conftest import SMALL
from salesmart.llm import alignment, dom, main_text, queries, trees, vector_codes
from salesmart.storage import Scratch

# vector codes


def test_codes_equal_sql(spark, scratch):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(5)
    assert difference(vector_codes.encode(vectors, scratch), connect(SMALL), vector_codes.SQL) is None


def brute_codes(rows):
    """(code, error) by a search through all entries, with Python integers."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[1]))
    whole = [[math.floor(x * 256) for x in r[1]] for r in kept]
    width = len(whole[0]) // 16
    cut = lambda x, p: x[p * width : (p + 1) * width]
    books = [[cut(x, p) for x in whole[:64]] for p in range(16)]

    def assign(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(x, p), entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(2):
        chosen = [[assign(x, p)[1] for p in range(16)] for x in whole]
        for p in range(16):
            for e in range(len(books[p])):
                members = [cut(x, p) for x, codes in zip(whole, chosen) if codes[p] == e]
                if members:
                    books[p][e] = [sum(column) // len(members) for column in zip(*members)]
    out = []
    for (vec_id, _), x in zip(kept, whole):
        found = [assign(x, p) for p in range(16)]
        out.append((vec_id, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    return out, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("count,width,spread", [(3, 16, 1.0), (70, 32, 0.1), (150, 16, 900.0), (130, 48, 0.0)])
def test_codes_equal_a_full_search(spark, scratch, count, width, spread):
    rng = random.Random(count)
    rows = [(n, [float(np.float32(rng.gauss(0, 1) * spread)) for _ in range(width)], n % 3 if n % 4 else None) for n in range(count)]
    rows += [(1000, None, 1), (1001, [None] * width, 1), (1002, [float("nan")] + [0.0] * (width - 1), 1), (1003, [float("inf")] * width, None)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = vector_codes.encode(made, scratch).collect()
    want, digest = brute_codes([(r[0], r[1]) for r in rows])
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {digest}
    labels, sums = {r[0]: r[2] for r in rows}, Counter()
    for vec_id, _, error in want:
        sums[labels[vec_id]] += error
    assert all(r.label_error == sums[labels[r.vec_id]] for r in got)


def test_bounds_hold_after_entries_move():
    """Bounds never exceed true distances, and assignments equal a full search, for any b and over several moves."""
    rng = np.random.default_rng(5)
    for b in (2, 3, 8, 20):
        x, book = rng.integers(-300, 300, (500, 4)), rng.integers(-300, 300, (64, 4))
        near, low, first = vector_codes.nearest(x, book, b)
        for step in (0, 3, 40, 0):
            moved = book + rng.integers(-step, step + 1, book.shape)
            drift = np.array([math.isqrt(int(((m - o) ** 2).sum()) * 64) + 1 if (m != o).any() else 0 for m, o in zip(moved, book)])
            near, low, first, needed = vector_codes.reassign(x, moved, drift, near, low)
            book, squared = moved, vector_codes.distances(x, moved)
            assert (near[:, 0] == squared.argmin(1)).all() and (first == squared.min(1)).all()
            for j in range(b):
                beyond = squared.astype(float)
                np.put_along_axis(beyond, near[:, : j + 1].astype(int), np.inf, 1)
                assert (low[:, j] / 8 <= np.sqrt(beyond.min(1)) + 1e-9).all()
            assert needed.min() >= 1 and (step or (needed == 1).mean() > 0.5)


def test_codes_edges(spark, scratch):
    kinds = "vec_id long, embedding array<float>, label int, near string, low int, error string, x int, code int, kind int"
    rows = [
        (5, [0.5] * 10, None), (5, [0.5] * 10, None), (None, [1.0] * 10, 2), (7, [1e30, -1e30] * 5, 2), (8, [1.0], 2), (9, [], 1), (10, [-0.001] * 10, 1),
    ]
    made = spark.createDataFrame([(*row, "a", 1, "b", 2, 3, 4) for row in rows], kinds)
    got = vector_codes.encode(made, scratch).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, 5), (False, 5), (False, 7), (False, 10), (True, 0)]
    assert all(r.error == 0 for r in got) and len({r.code for r in got if r.vec_id == 5}) == 1
    assert vector_codes.encode(made.limit(0), scratch).collect() == []
    assert vector_codes.encode(made.where("vec_id = 9"), scratch).collect()[0].error == 0
    assert vector_codes.encode(made.withColumn("embedding", F.lit(None).cast("array<float>")), scratch).collect() == []


def test_depth_follows_what_was_needed():
    assert vector_codes.next_depth(np.array([0, 990, 5, 5, 0, 7]), 4) == 2
    assert vector_codes.next_depth(np.array([0, 50, 10, 10, 30, 7]), 4) == 4
    assert vector_codes.next_depth(np.zeros(6, int), 4) == 4


# alignment


@pytest.fixture(scope="module")
def tokenizers():
    return queries.tokenizer_json("byte_bpe_50k.json"), queries.piece_model()


def brute_alignment(rows, tokenizer_json, model):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_str(tokenizer_json), SentencePieceProcessor(model_proto=model)
    a.encode_special_tokens = True
    names, shown = {i: token for token, i in a.get_vocab().items()}, alignment.shown_bytes()
    of_a = lambda i: bytes(shown[c] for c in names[i])
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        if not text or b"".join(map(of_a, ids_a)) != raw or b"".join(map(of_b, ids_b)) != raw:
            found.append((doc_id, None))
            continue
        owner_a, owner_b = ([n for n, i in enumerate(ids) for _ in of(i)] for ids, of in ((ids_a, of_a), (ids_b, of_b)))
        links = [(ids_a[p], ids_b[q]) for p, q in sorted(set(zip(owner_a, owner_b)))]
        cuts = [at for at in range(1, len(raw)) if owner_a[at] != owner_a[at - 1] and owner_b[at] != owner_b[at - 1]] + [len(raw)]
        begin, groups = 0, []
        for cut in cuts:
            one, other = (dict.fromkeys(owner[begin:cut]) for owner in (owner_a, owner_b))
            groups.append(",".join(str(ids_a[n]) for n in one) + "|" + ",".join(str(ids_b[n]) for n in other))
            begin = cut
        counts.update(set(links))
        found.append((doc_id, (len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    best = Counter()
    for (first, _), n in counts.items():
        best[first] = max(best[first], n)
    for doc_id, got in found:
        if got is None:
            yield (doc_id, 0, 0, 0, 0, 0, 0, "")
        else:
            links = got[3]
            yield (doc_id, *got[:3], len(links), sum(counts[link] == best[link[0]] for link in links), sum(counts[link] for link in links), got[4])


ODD_TEXTS = [
    None, "", " ", "a", "<|endoftext|> and </s><unk> <0x41>", "two  spaces and\ttabs \n\n lines ", " lead", "trail ", "x▁y", "日本語のテキスト 漢字 かな", "emoji 😀😀 👩‍👩‍👧 end",
    "don't we'll 'tis it's", "nbsp here  thin \x1c sep \x85 nel", "é combining", "ﬁ ligature ½ ² ª", "\x00 null", "1234567 89 v2.0", "ab " * 3000, "x" * 5000,
    "Ünïcode wörter über alles", "mixed 中 a b 中 c", "https://a.b/c?d=e&f=%20", "﻿bom", "-- — … “quoted” ’s €5",
]


@pytest.mark.parametrize("most", [alignment.MOST_PAIRS, 300, 0])
def test_alignment_equals_a_walk_over_bytes(spark, scratch, tokenizers, most):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + n, text) for n, text in enumerate(ODD_TEXTS)] + [(None, "no id here"), (10_001, "twice"), (10_001, "twice")]
    made = spark.createDataFrame(rows, "doc_id long, text string").withColumns({name: F.lit(1) for name in ("pairs", "pair", "n", "times", "rest", "_row", "a", "n_a")})
    got = Counter(tuple(row) for row in alignment.align(made.repartition(3), *tokenizers, scratch, most).collect())
    assert got == Counter(brute_alignment(rows, *tokenizers))


def test_alignment_of_an_empty_table(spark, scratch, tokenizers):
    made = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(made, *tokenizers, scratch).collect() == []


def test_pieces_segments_and_forgetting_change_nothing(spark, tokenizers):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(60).collect()] + ODD_TEXTS
    once, parted = alignment.Aligner(*tokenizers), alignment.Aligner(*tokenizers, kept=50)
    whole = alignment.Aligner(*tokenizers)
    whole.cuts = False
    for one, other, third in zip(once.texts(texts), parted.texts(texts, 100, 500), whole.texts(texts)):
        for left, middle, right in zip(one, other, third):
            assert np.array_equal(left, middle) and np.array_equal(left, right)
    assert len(parted.recent) <= 600


def test_run_skipping_finds_all_common_ends():
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randint(1, 400)
        dense = rng.choice([0.2, 0.9, 0.99])
        a, b = (sorted({size, *(n for n in range(1, size) if rng.random() < dense)}) for _ in range(2))
        ends, i, j = [], 0, 0
        for at_i, at_j, run, p, q in alignment.stretches(np.array(a, np.uint32), np.array(b, np.uint32)):
            assert (at_i, at_j) == (i, j) and a[i : i + run] == b[j : j + run]
            ends += a[i : i + run]
            if p > i + run:
                assert a[p - 1] == b[q - 1] and not set(a[i + run : p - 1]) & set(b[j + run : q - 1])
                ends.append(a[p - 1])
            i, j = p, q
        assert ends == sorted(set(a) & set(b)) and (i, j) == (len(a), len(b))


# main text


@pytest.fixture(scope="module")
def model(spark):
    return main_text.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_main_text_equals_the_marked_article(spark, model):
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    right = 0
    rows = main_text.extract(pages).collect()
    sources = {row.page_id: row.html for row in pages.collect()}
    for row in rows:
        inside = re.search("(?s)<article>(.*?)</article>", sources[row.page_id])[1]
        want = " ".join(entities.unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)>", " ", inside))).split())
        right += row.text == want
        assert row.n_chars == len(row.text)
    assert len(rows) == len(sources) and right >= 0.99 * len(rows)


def test_layouts_the_model_has_not_seen(spark, model):
    """Held-out pages in layouts of other seeds: nearly all words of the article and few others."""
    scores = []
    held = [row.html for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    for source in main_text.layouts(held, 3, seed=99):
        if "data-y" not in source:
            continue
        page = dom.Page(source)
        want = Counter(" ".join(text for text, label in zip(page.texts, page.labels) if text and label).split())
        import re

        got = Counter(main_text.main_texts([re.sub(' data-y="[01]"', "", source)], model)[0].split())
        scores.append(2 * sum((want & got).values()) / max(1, sum(want.values()) + sum(got.values())))
    assert np.mean(scores) > 0.94 and np.mean(np.array(scores) > 0.9) > 0.85


def test_choices_agree_along_the_tree():
    rng = np.random.default_rng(1)
    page = dom.Page("<div><section><p>a<p>b<ul><li>c<li>d</ul></section><p>e</div><div>f<div>g</div>h</div>")
    for _ in range(200):
        p = rng.random(len(page.tags))
        kept = page.decode(p)
        leaves = [[v for v, text in enumerate(page.texts) if text and _under(page, v, u)] for u in range(len(page.tags))]
        for v, keep in enumerate(kept):
            if keep and page.texts[v] is None:
                assert all(kept[leaf] for leaf in leaves[v])


def _under(page, v, u):
    while v >= 0:
        if v == u:
            return True
        v = page.parents[v]
    return False


@pytest.mark.parametrize(
    "source,texts",
    [
        ("<p>a&amp;b &lt;i&gt;<p>c  \n d<br>e", ["a&b <i>", "c d e"]),
        ("<div>x<b>y</b>z<p><b>u<br><p>v</b>w</div>t", ["xyz", "u", "vw", "t"]),
        ('<script>var t="</p><p>no";</script><style>p{}</style><p title="a > b">yes</p><!-- <p>no --><textarea><p>no</textarea>', ["yes"]),
        ("<head><title>no</title></head><body><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c", "d", "e"]),
        ("<p hidden>no</p><div style='display:none'>no<p>no</p></div><p title='the hidden one'>yes", ["yes"]),
        ("<p>un<closed <p>a</p></b></div><p", ["un", "a"]),
        ("", []), ("no markup at all", ["no markup at all"]), ("<", ["<"]), ("a < b", ["a < b"]),
        ("<a href=x>l<div>i</div>nk</a>", ["l", "i", "nk"]),
    ],
)
def test_pages_are_read_as_blocks(source, texts):
    assert [text for text in dom.Page(source).texts if text] == texts


def test_main_text_edges(spark):
    long = "<article><p>" + "many words here " * 60_000 + "</p></article><footer>end</footer>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<nav>a</nav>"), (4, "u", long), (4, "u", long), (None, "u", "plain text"), (6, "u", "<article><h1>T</h1><p>one. two.</p></article>" * 2)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({name: F.lit(1) for name in ("text", "n_chars", "key", "p")})
    got = main_text.extract(made).collect()
    assert sorted((r.page_id is None, r.page_id or 0) for r in got) == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 4), (False, 6), (True, 0)]
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == by_id[2].text == "" and all(r.n_chars == len(r.text) for r in got)
    assert main_text.extract(made.limit(0)).collect() == []
    unmarked = {r.page_id: r.text for r in main_text.extract(made.where("page_id < 4 or page_id is null")).collect()}
    assert unmarked[3] == "" and unmarked[None] == "plain text"


def test_deeply_nested_pages_are_read():
    page = dom.Page("<div>" * 20_000 + "x" + "</div>" * 20_000)
    assert page.text(page.decode(np.full(len(page.tags), 0.9))) == "x"


def test_trees_learn_what_one_split_cannot():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = trees.fit(x[:3000], y[:3000], np.ones(3000), trees=20, depth=3)
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert len(model.probability(x[:0])) == 0


# earlier operators


def test_edited_fingerprints_beyond_the_basic_plane(spark):
    """Every edited fingerprint is the fingerprint of the edited text itself, with emoji and rare ideographs throughout."""
    from salesmart.llm import fingerprints

    rng = random.Random(4)
    letters = "ab \U0001f600\U0001f680\U00020000\U0002a6d6é漢\U0001d11e"
    texts = ["\U0001f600" * 20, "ab\U0001f600cdefghijk", "", "\U00020000" * 3, *("".join(rng.choices(letters, k=rng.randint(5, 400))) for _ in range(40))]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(made).collect()}
    edited = {}
    for n, text in enumerate(texts):
        cut, after = len(text) // 3, texts[n - 1]
        edited[n] = text[: len(text) - cut] + after[:cut]
        assert got[n].n_chars == len(text) and got[n].edited_sha256 == hashlib.sha256(edited[n].encode()).hexdigest()
    whole = spark.createDataFrame(list(edited.items()), "doc_id long, text string")
    want = {r.doc_id: r.fingerprint for r in fingerprints.fingerprinted(whole).collect()}
    assert all(got[n].edited_fingerprint == want[n] for n in want)
    inner = spark.createDataFrame([(texts[0],)], "text string").select(F.size(fingerprints.anchors(F.col("text")))).first()[0]
    assert inner == 20 - fingerprints.K + 1


@pytest.mark.parametrize("most", [10_000, 1])
def test_language_sample_shuffles_chosen_texts_only(spark, most):
    from salesmart.llm import langid

    rows = [(n, f"text number {n}", "en" if n % 3 else "fr") for n in range(3000)] + [(7, "text number 7", "en")] * 500
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("count", F.lit(1)).repartition(4)
    picked = langid.sample(made, 40, most)
    got = Counter(r.lang for r in picked.collect())
    assert got == {"en": 40, "fr": 40} and len({r.text for r in picked.collect()}) == 80
    wanted = sorted(r[0] for r in made.where("lang = 'fr'").select(F.xxhash64("doc_id", "text")).distinct().collect())[:40]
    chosen = {r.text for r in picked.where("lang = 'fr'").collect()}
    assert chosen == {r.text for r in made.where(F.xxhash64("doc_id", "text").isin(wanted)).select("text").collect()}


def test_word_tables_forget_without_changing_ids(monkeypatch):
    from tokenizers import Tokenizer

    from salesmart.llm import packing

    monkeypatch.setattr(packing, "WORDS_KEPT", 3)
    model = Tokenizer.from_str(queries.tokenizer_json())
    words = packing.Words(model)
    for word in "the cat's 42nd sat-on $$$% the über the mat cat's the ärger".split() * 3:
        assert np.frombuffer(words[word], np.uint32).tolist() == model.encode(word, add_special_tokens=False).ids
    assert len(words) <= 3 and len(words.older) <= 3


def test_packing_passes_small_batches(spark, scratch):
    """A task gets some 4 MB of text at a time, whatever the number of rows, and the session's setting is as before."""
    from salesmart.llm import packing, tasks

    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}
    texts = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.concat("id", F.repeat(F.lit(" word"), 1000)).alias("text"))

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    with tasks.small_batches(spark):
        held = [row.size for row in texts.mapInArrow(sizes, "size long").collect()]
    assert len(held) > 2 and max(held) < 5 << 20

    class Watched(Scratch):
        def table(self, df, name_, **options):
            seen[name_] = spark.conf.get(name)
            return super().table(df, name_, **options)

    before = spark.conf.get(name)
    rows = packing.pack(texts.limit(20), queries.tokenizer_json(), Watched(spark, "watched"))
    assert seen["tokens"] == "4m" and spark.conf.get(name) == before == seen["queues"]
    assert rows.agg(F.sum("length")).first()[0] == rows.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]


def test_a_new_large_cache_takes_the_place_of_all_others(monkeypatch):
    import sys

    from salesmart.llm import tasks

    monkeypatch.setitem(sys.modules["__main__"].__dict__, "_salesmart_caches", {})
    tasks.worker_cache("powers")["x"] = 1
    tasks.worker_cache("first", large=True)["x"] = 2
    tasks.worker_cache("powers")["x"] = 3
    assert tasks.worker_cache("first", large=True) == {"x": 2} and tasks.worker_cache("powers") == {"x": 3}
    assert tasks.worker_cache("second", large=True) == {} == tasks.worker_cache("powers")
    assert set(sys.modules["__main__"]._salesmart_caches) == {("second", True), ("powers", False)}


def test_language_passes_small_batches(spark):
    """While the trees are fitted and the kept documents written; the session's setting is as before, and nothing else changes."""
    from salesmart.llm import langid

    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    class Watched(Scratch):
        def table(self, df, name_, **options):
            seen[name_] = spark.conf.get(name)
            return super().table(df, name_, **options)

    said = {"en": "the house of the man who went there ", "de": "das haus des mannes der dorthin ging "}
    rows = [(n, said[lang] * 5 + str(n), lang, "a", n) for n, lang in enumerate(["en", "de"] * 20)] + [(40, None, "en", "a", 1), (41, "123", None, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get(name)
    kept = langid.kept_documents(docs, Watched(spark, "watched-language"))
    assert seen == {"kept": "4m"} and spark.conf.get(name) == before
    assert kept.schema == docs.schema and sorted(map(tuple, kept.collect())) == rows[:40]


def test_a_new_large_cache_gives_memory_back_first(monkeypatch):
    import sys

    from salesmart.llm import tasks

    left = []
    monkeypatch.setitem(sys.modules["__main__"].__dict__, "_salesmart_caches", {("old", True): {"x": 1}})
    monkeypatch.setattr(tasks, "release", lambda: left.append(dict(sys.modules["__main__"]._salesmart_caches)))
    tasks.worker_cache("new", large=True)
    tasks.worker_cache("new", large=True)
    assert left == [{}]


def test_words_and_their_pieces_share_a_table(monkeypatch):
    """A piece goes to the model once while the table holds it, whatever stands beside it and however many others came between."""
    from tokenizers import Tokenizer

    from salesmart.llm import packing

    monkeypatch.setattr(packing, "WORDS_KEPT", 12)
    tokenizer, asked = Tokenizer.from_str(queries.tokenizer_json()), []

    class Counted:
        def tokenize(self, letters):
            asked.append(letters)
            return tokenizer.model.tokenize(letters)

    words = packing.Words(tokenizer)
    words.model = Counted()
    text = "house one two three four five six house, (house) house's 'tis 4you x''s"
    ids = [np.frombuffer(words[word], np.uint32).tolist() for word in text.split()]
    assert ids == [tokenizer.encode(word, add_special_tokens=False).ids for word in text.split()]
    assert max(Counter(asked).values()) == 1 and len(words) <= 12 and len(words.older) <= 12


def test_near_duplicates_pass_small_batches(spark):
    """While anything with texts is written; the session's setting is as before, and so are the classes."""
    from salesmart.llm import near_dup

    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", {}

    class Watched(Scratch):
        def table(self, df, name_, **options):
            seen[name_] = spark.conf.get(name)
            return super().table(df, name_, **options)

    text = " ".join(f"word{n}" for n in range(60))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " more"), (4, "another text of a few words"), (5, None)], "doc_id long, text string")
    before = spark.conf.get(name)
    rows = near_dup.near_duplicates(docs, Watched(spark, "watched-near"))
    assert {seen[x] for x in ("frequencies", "sketches", "links")} == {"4m"} and spark.conf.get(name) == before
    assert {row.doc_id: row.class_id for row in rows.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_word_hashes_keep_a_table_little_longer_than_the_buffer(monkeypatch):
    import sys

    from salesmart.llm import kernels, tasks

    monkeypatch.setitem(sys.modules["__main__"].__dict__, "_salesmart_caches", {})
    hashes = kernels.words(np.frombuffer(b"one two " * (1 << 17), np.uint8))[1]
    assert len(set(hashes.tolist())) == 2
    assert all(len(table) <= (1 << 20) + (1 << 16) for table in tasks.worker_cache("powers").values())
