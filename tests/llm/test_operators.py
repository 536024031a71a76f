"""Every operator against a brute-force version, an exact round trip or held-out accuracy."""

from __future__ import annotations

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from check import connect, difference
from conftest import SMALL
from pyspark.sql import functions as F

from salesmart.llm import chat, ctw, fingerprints, graphs, kernels, langid, mixing, near_dup, packing, quality, queries, sharding, url_filter
from salesmart.storage import Scratch

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {row.doc_id: row.text or "" for row in documents.collect()}


def rows_of(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


def docs(spark, pairs, **extra):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in pairs], "doc_id long, text string, lang string, source string")


# 1 mixing


def test_mixing_equals_sql(spark):
    assert difference(queries.op1_mixing(spark, SMALL), connect(SMALL), mixing.SQL) is None


def test_mixing_meets_targets_and_repeats_itself(spark, documents, scratch):
    first = mixing.mix(documents, scratch).collect()
    again = mixing.mix(documents.repartition(5), Scratch(spark, "again")).collect()
    assert sorted(first) == sorted(again)
    source = {row.doc_id: row.source for row in documents.collect()}
    taken, target, largest = Counter(), {}, Counter()
    for row in first:
        assert 0 <= row.taken <= 2 * row.size
        taken[source[row.doc_id]] += row.taken
        target[source[row.doc_id]] = row.target
        largest[source[row.doc_id]] = max(largest[source[row.doc_id]], row.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert math.isclose(sum(target.values()), 1.5 * sum(row.size for row in first))


def test_mixing_reshares_what_a_small_source_cannot_take(spark, scratch):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000), ("z", 0)], "source string, source_size long")
    got = {row.source: row.target for row in mixing.targets(sizes).collect()}
    # weights a 3, b 1, z 2, null 3: a stops at 20, z at 0; b and null share the rest 1 : 3, null stops at 2000
    assert got == {"a": 20.0, "z": 0.0, None: 2000.0, "b": 1.5 * 2010 - 2020}


# 2 near duplicates


def shingles(text):
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_classes(texts, similar=0.8):
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets, ids = {i: shingles(t) for i, t in texts.items()}, sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if texts[a] == texts[b] or shared and shared / (len(sets[a]) + len(sets[b]) - shared) >= similar:
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in texts}


def test_classes_equal_all_pairs(spark, documents, texts, scratch):
    found = rows_of(near_dup.near_duplicates(documents, scratch))
    assert {i: found[i].class_id for i in found} == brute_classes(texts)
    assert all(row.kept == (row.doc_id == row.class_id) for row in found.values())


def test_a_large_group_is_one_class_across_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    made = {0: " ".join(words)}
    for i in range(1, 60):
        changed = list(words)
        changed[rng.integers(len(words))] = f"x{i}"
        made[i] = " ".join(changed)
    made |= {100 + i: " ".join(f"y{i}-{j}" for j in range(100)) for i in range(20)}
    found = rows_of(near_dup.near_duplicates(docs(spark, made.items()), scratch))
    assert {found[i].class_id for i in range(60)} == {0}
    assert all(found[i].class_id == i for i in found if i >= 100)


@pytest.mark.parametrize("most", [0.02, 3])
def test_split_buckets_keep_their_pairs(spark, scratch, monkeypatch, most):
    # at 0.02 the two texts of a bucket are dealt to 100 parts; at 3 only the large group's buckets are split
    monkeypatch.setattr(near_dup, "HOT_BUCKET", most)
    made = {}
    for pair in range(60):
        words = [f"p{pair}-{i}" for i in range(100)]
        made[2 * pair], made[2 * pair + 1] = " ".join(words), " ".join([*words[:50], "other", *words[51:]])
    for i in range(20):
        made[1000 + i] = " ".join([*[f"g{j}" for j in range(i)], f"x{i}", *[f"g{j}" for j in range(i + 1, 100)]])
    found = rows_of(near_dup.near_duplicates(docs(spark, made.items()), scratch))
    assert {i: found[i].class_id for i in made} == {i: 1000 if i >= 1000 else i // 2 * 2 for i in made}


def test_slices_of_very_few_words(spark):
    import pyarrow as pa

    for n in range(1, 8):
        hashes, times, offsets = near_dup.shingled(pa.array([" ".join(f"w{i}" for i in range(n))]))
        assert len(hashes) == max(1, n - 4) and list(times) == [1] * len(hashes) and list(offsets) == [0, len(hashes)]
    long = "lorem ipsum dolor sit amet " * 50_000
    made = docs(spark, [(1, "a " + long), (2, "two words"), (3, "b " + long), (4, "two words")]).coalesce(1)
    found = rows_of(near_dup.near_duplicates(made, Scratch(spark, "few")))
    assert found[2].class_id == found[4].class_id == 2


def test_samples_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(3)
    hashes = np.sort(rng.integers(1, 1 << 52, 300).astype(np.uint64))
    a = (hashes[:200], rng.uniform(0.5, 5, 200).astype(np.float32))
    b = (hashes[60:], rng.uniform(0.5, 5, 240).astype(np.float32))
    b[1][:140] = a[1][60:] * rng.uniform(0.7, 1.3, 140).astype(np.float32)
    number = near_dup.BANDS * near_dup.ROWS * 4
    drawn = near_dup.samples(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, 200, 440]), number)
    assert abs((drawn[0] == drawn[1]).mean() - near_dup.similarity(a, b)) < 0.1


def test_components_equal_union_find(spark, scratch):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 150, (110, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    got = {row.node: row.component for row in graphs.components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)} | {x: root(x) for x in got}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}


# 3 fingerprints


def brute_sketch(text):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    h = [signed(xxhash.xxh64(text[i : i + fingerprints.S].encode(), seed=42).intdigest()) for i in range(len(text) - fingerprints.S + 1)]
    pack = lambda x: x.to_bytes(8, "little", signed=True)
    if len(text) < fingerprints.K:
        return [xxhash.xxh64(text.encode(), seed=42).intdigest() >> 32] if text else []
    found = set()
    for i in range(len(text) - fingerprints.K + 1):
        inner = h[i : i + fingerprints.W]
        if min(inner) in (inner[0], inner[-1]):
            found.add(xxhash.xxh64(pack(inner[-1]), seed=xxhash.xxh64(pack(inner[0]), seed=42).intdigest()).intdigest() >> 32)
    return sorted(found)[: fingerprints.SKETCH]


def hexed(sketch):
    return "".join(f"{h:08x}" for h in sketch)


def test_fingerprints_equal_brute_force(spark, texts):
    got = rows_of(queries.op3_fingerprints(spark, SMALL))
    ids = sorted(texts, reverse=True)
    for n, i in enumerate(ids[:60] + ids[-2:]):
        text, after = texts[i], texts[ids[(ids.index(i) + 1) % len(ids)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == hexed(brute_sketch(text)) and row.edited_fingerprint == hexed(brute_sketch(edited))
        assert row.near_edited >= row.near_next or len(text) < 100


def test_sorting_everything_equals_the_cut(spark):
    few = spark.createDataFrame([([5, 5, 1, 9],), ([],), ([1 << 31] * 300 + list(range(1 << 31, (1 << 31) + 100)),)], "h array<long>")
    got = [row[0] for row in few.select(fingerprints.smallest(F.col("h"))).collect()]
    assert got == [[1, 5, 9], [], list(range(1 << 31, (1 << 31) + 64))]


# 4 url filter


def test_rules_and_parsing(spark):
    cases = {
        "HTTP://Www.Example.NET/en/1": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/de/1": ("example.net", "/de/1", "net/", "block"),
        "http://notexample.net": ("notexample.net", "", None, "allow"),
        "x://a.org/fr/?q=/": ("a.org", "/fr/", "org/fr/", "allow"),
        "x://myexample.com/de/": ("myexample.com", "/de/", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://b://c": ("b:", "//c", None, "allow"),
    }
    made = spark.createDataFrame([(i, url, None) for i, url in enumerate(cases)], "page_id long, url string, html string")
    got = rows_of(url_filter.judge(made, Scratch(spark, "rules")), "page_id")
    for i, want in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want


def test_ranks_equal_power_iteration(spark, scratch):
    edges = {("a", "b"): 2.0, ("a", "c"): 1.0, ("b", "c"): 1.0, ("c", "a"): 1.0, ("d", "c"): 3.0}
    seeds = {"a": (1.0, 0.0), "c": (0.0, 0.5), "d": (0.0, 0.0)}
    trust, distrust = defaultdict(float), defaultdict(float)
    for host, (good, bad) in seeds.items():
        trust[host], distrust[host] = 0.15 * good, 0.15 * bad
    for _ in range(url_filter.ROUNDS):
        t, d = defaultdict(float), defaultdict(float)
        for host, (good, bad) in seeds.items():
            t[host], d[host] = 0.15 * good, 0.15 * bad
        for (src, dst), w in edges.items():
            t[dst] += 0.85 * trust[src] * w / sum(x for (s, _), x in edges.items() if s == src)
            d[src] += 0.85 * distrust[dst] * w / sum(x for (_, e), x in edges.items() if e == dst)
        trust, distrust = t, d
    frame = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, weight double")
    start = spark.createDataFrame([(h, g, b) for h, (g, b) in seeds.items()], "host string, trusted double, blocked double")
    for row in url_filter.ranks(frame, start, scratch).collect():
        assert math.isclose(row.trust, trust[row.host], abs_tol=1e-12) and math.isclose(row.distrust, distrust[row.host], abs_tol=1e-12)


def test_who_links_to_bad_hosts_is_suspect(spark, scratch):
    link = lambda host: f"<a href='https://{host}/x'>"
    made = [(1, "http://bad.net/", ""), (2, "http://farm.biz/a", link("bad.net") * 3), (3, "http://fine.biz/a", link("good.org")), (4, "http://good.org/fr/", "")]
    got = rows_of(url_filter.judge(spark.createDataFrame(made, "page_id long, url string, html string"), scratch), "page_id")
    assert [got[i].verdict for i in (1, 2, 3, 4)] == ["block", "block", "allow", "allow"]


def test_many_who_link_to_one_bad_host_are_suspect(spark, scratch):
    link = lambda host: f"<a href='https://{host}/x'>"
    made = [(0, "http://bad.net/", ""), (1, "http://good.org/fr/", "")]
    made += [(10 + i, f"http://farm{i}.biz/a", link("bad.net")) for i in range(40)]
    made += [(100 + i, f"http://behind{i}.biz/a", link(f"farm{i}.biz")) for i in range(2)]
    made += [(200 + i, f"http://fine{i}.biz/a", link("bad.net") + link("good.org") + link(f"other{i}.biz")) for i in range(5)]
    got = rows_of(url_filter.judge(spark.createDataFrame(made, "page_id long, url string, html string"), scratch), "page_id")
    assert {i: row.verdict for i, row in got.items()} == {i: "allow" if i == 1 or i >= 200 else "block" for i, *_ in made}


# 5 context-tree weighting


def brute_ctw(training, depth):
    """Counts by (context, node), shares from the leaves up, and a function giving log10 of a text."""
    edge = bytes([255])
    counts = defaultdict(lambda: [0, 0])
    for text in training:
        data = edge * depth + text + edge
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                node = 1
                for k in range(8):
                    bit = data[i] >> (7 - k) & 1
                    counts[data[i - d : i], node][bit] += 1
                    node = node * 2 + bit
    log_kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    log_pw, own = {}, {}
    for d in range(depth, -1, -1):
        below = defaultdict(float)
        for (context, node), value in log_pw.items():
            if len(context) == d + 1:
                below[context[1:], node] += value
        for (context, node), (a, b) in list(counts.items()):
            if len(context) == d:
                kt = log_kt(a, b)
                if d == depth:
                    log_pw[context, node], own[context, node] = kt, 1.0
                else:
                    log_pw[context, node] = math.log(0.5) + np.logaddexp(kt, below[context, node])
                    own[context, node] = math.exp(math.log(0.5) + kt - log_pw[context, node])

    def score(text):
        data, total = edge * depth + text + edge, 0.0
        for i in range(depth, len(data)):
            node = 1
            for k in range(8):
                q = None
                for d in range(depth, -1, -1):
                    key = (data[i - d : i], node)
                    if key in counts:
                        a, b = counts[key]
                        p = (b + 0.5) / (a + b + 1)
                        q = p if q is None else own[key] * p + (1 - own[key]) * q
                bit = data[i] >> (7 - k) & 1
                q = 0.5 if q is None else q
                total += math.log10(q if bit else 1 - q)
                node = node * 2 + bit
        return total

    return score


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_context_trees_equal_brute_force(spark, scratch, monkeypatch):
    monkeypatch.setattr(ctw, "MOST_WORDS", 3)
    made = {i: t for i, t in enumerate(["The cat sat on the mat", "the CAT ran", "é ü\tthe end", "", None, "the cat sat on the hat zzz", "on on on on", "never seen qqq"])}
    training = F.col("doc_id") < 5
    got = rows_of(ctw.scored(docs(spark, made.items()), scratch, training))
    score = brute_ctw([lower(made[i] or "").encode() for i in range(5)], ctw.DEPTH)
    tokens = lambda t: [*WORD.findall(lower(t or "")), None]
    counts = Counter(token for i in range(5) for token in tokens(made[i]))
    n, v = sum(counts.values()), len(counts)
    for i, text in made.items():
        own, row = tokens(text), got[i]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (i >= 5, len(own), sum(counts[t] > 0 for t in own), n)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert math.isclose(row.score, score(lower(text or "").encode()), rel_tol=1e-4, abs_tol=1e-4)


@pytest.mark.parametrize("most", [1, 40, 400])
def test_nodes_beyond_the_broadcast_count(spark, scratch, monkeypatch, most):
    monkeypatch.setattr(ctw, "MOST_NODES", most)
    made = {i: t for i, t in enumerate(["The cat sat on the mat", "the CAT ran", "é ü\tthe end", "", None, "the cat sat on the hat zzz", "on on on on", "never seen qqq"])}
    got = rows_of(ctw.scored(docs(spark, made.items()), scratch, F.col("doc_id") < 5))
    score = brute_ctw([lower(made[i] or "").encode() for i in range(5)], ctw.DEPTH)
    for i, text in made.items():
        assert math.isclose(got[i].score, score(lower(text or "").encode()), rel_tol=1e-4, abs_tol=1e-4)


def test_model_is_better_than_bytes_by_chance(spark):
    rows = queries.op5_context_tree(spark, SMALL).where("held_out").collect()
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert rows and all(zlib.crc32(str(row.doc_id).encode()) % 10 == 0 for row in rows)
    bits = -sum(row.score for row in rows) / math.log10(2) / sum(len(texts[row.doc_id].encode()) + 1 for row in rows)
    assert bits < 3


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 7.25, 1e3, 1e9]
    got = spark.createDataFrame([(x,) for x in values], "x double").select("x", ctw._log_gamma(F.col("x")).alias("y")).collect()
    assert all(math.isclose(row.y, math.lgamma(row.x), rel_tol=1e-9, abs_tol=1e-9) for row in got)


# 6 packing


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in queries.op6_packing(spark, SMALL).collect():
        pieces[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4"), 0
        for row in sorted(pieces[i], key=lambda row: row.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, rows in sequences.items():
        at = 0
        for row in sorted(rows, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        assert at == packing.SEQUENCE or number == max(sequences)


def test_windows_hold_the_wanted_shares(spark, scratch):
    from pyspark.sql import Row

    made = spark.createDataFrame([Row(doc_id=i, source="ab"[i % 4 == 0], text="word " * 400) for i in range(80)])
    rows = packing.pack(made, queries.tokenizer_json(), scratch, {"a": 3.0, "b": 1.0}, sequence=512, unit=64).collect()
    held = defaultdict(Counter)
    for row in rows:
        if row.length == 64:
            held[row.sequence_id][row.source] += row.length
    full = [h for h in held.values() if sum(h.values()) == 512][:30]
    assert len(full) > 20 and all(abs(h["a"] / 512 - 0.75) <= 0.13 for h in full)


@pytest.mark.parametrize("shares", [None, {"short": 1.0, "long": 2.0}])
def test_short_documents_get_their_share_of_every_window(spark, scratch, shares):
    # 200 documents of 51 tokens against 20 of 1,021: a third of all tokens; and a few sources of less than a block
    made = [(i, "short", "word " * 50) for i in range(200)] + [(1000 + i, "long", "word " * 1020) for i in range(20)]
    made += [(2000 + i, f"tiny{i}", "word " * 20) for i in range(7)] + [(3000, None, "word")]
    frame = spark.createDataFrame(made, "doc_id long, source string, text string")
    rows = packing.pack(frame, queries.tokenizer_json(), scratch, shares, sequence=512, unit=64).collect()
    held, at, lengths = defaultdict(Counter), defaultdict(int), Counter()
    for row in sorted(rows, key=lambda row: (row.sequence_id, row.offset)):
        assert row.offset == at[row.sequence_id]
        at[row.sequence_id] += row.length
        held[row.sequence_id][row.source] += row.length
        lengths[row.doc_id] += row.length
    assert sorted(held) == list(range(len(held))) and all(n == 512 for s, n in at.items() if s < max(at))
    assert lengths == {i: len(text.split()) + 1 for i, _, text in made}
    assert all(abs(held[w]["short"] / 512 - 1 / 3) <= 0.26 for w in sorted(held)[:-2])


@pytest.mark.parametrize("text", ["", "It's 3² ÀÉÎ don't", "İstanbul ŉ", "日本語 text", "a\x1cb\x85c\u00a0d", "<|endoftext|> x", "Σίσυφος ΟΔΟΣ", "e\u0301 \u200b!", "µ ª º ß ſ × ÷"])
def test_word_lookups_equal_the_tokenizer(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    tokenizer.encode_special_tokens = True
    ids = np.frombuffer(packing.encoder(queries.tokenizer_json())(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


# 7 chat


def test_conversations_round_trip(spark):
    got = rows_of(queries.op7_chat(spark, SMALL), "conv_id")
    turns = defaultdict(list)
    for row in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        turns[row.conv_id].append(row)
    said = "\\### Assistant: </turn> ok"
    turns[-7] = [chat_row for chat_row in spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], chat.CANONICAL).collect()]
    assert set(got) == set(turns)
    for conv, own in turns.items():
        own.sort(key=lambda row: row.turn)
        loss = "".join(row.text or "" for row in own if row.role == "assistant")
        row = got[conv]
        assert (row.n_turns, row.loss_chars) == (len(own), len(loss))
        assert row.turns_sha256 == hashlib.sha256("".join(f"{x.role}\n{x.text or ''}\n" for x in own).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("text", ["", "\\", "\\\\", "#", "### user: hi</turn>\n", "<", "\\<", "a: b", "\n### x: </turn>\n", "é\\#ü" * 50])
def test_control_strings_come_back(spark, text):
    made = spark.createDataFrame([(1, 0, text, text), (1, 1, "assistant", text)], chat.CANONICAL)
    rows = chat.format_turns(made).orderBy("turn").collect()
    assert chat.parse("".join(row.formatted for row in rows)) == [(text, text), ("assistant", text)]
    assert chat.unescape(rows[1].formatted[rows[1].loss_start :][: rows[1].loss_length]) == text


def test_layouts_are_told_by_their_paths(spark):
    want = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    frames = [
        spark.sql("SELECT 1L conv_id, 'q' prompt, 'a' response, 7 turn"),
        spark.sql("SELECT 1L conv_id, array(struct('user' role, 'q' content), struct('assistant' role, 'a' content)) messages, 'x' extra"),
        spark.sql("SELECT 1L conv_id, array(struct('human' `from`, 'q' value), struct('gpt' `from`, 'a' value)) conversations"),
        spark.sql("SELECT 1L conv_id, 'q' instruction, '' input, 'a' output"),
    ]
    for frame in frames:
        assert [tuple(row) for row in chat.canonical_turns(frame).orderBy("turn").collect()] == want
    with pytest.raises(ValueError, match="no declared layout"):
        chat.canonical_turns(spark.sql("SELECT 1L conv_id, 'x' body"))


def test_json_rows_choose_their_own_layout(spark):
    lines = [
        {"prompt": "q", "response": "a"},
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"output": "a", "instruction": "q"},
        {"other": 1},
        {"id": 7, "source": {"x": [1]}, "prompt": "q", "response": "a"},
        {"messages": [None, {"role": "user", "content": "q", "time": 1}, {"content": "a", "role": "assistant"}], "meta": None},
        {"messages": [{"role": "user"}, {"content": "q"}], "prompt": "q", "response": "a"},
        {"messages": [], "prompt": None, "response": "a", "system": "s"},
        {"messages": "text"},
        [1, 2],
    ]
    made = spark.createDataFrame([(i, json.dumps(line)) for i, line in enumerate(lines)] + [(90, "no json"), (91, None)], "conv_id long, line string")
    got = defaultdict(list)
    for row in chat.canonical_json(made, "line").orderBy("conv_id", "turn").collect():
        got[row.conv_id].append((row.role, row.text))
    plain = [("user", "q"), ("assistant", "a")]
    third = [("user", None), (None, "q")]  # equally many paths: the layout declared first
    assert got == {i: plain for i in (0, 1, 2, 3, 5, 6)} | {7: third, 8: [("system", "s"), ("user", None), ("assistant", "a")]}
    counts = {row.layout: row["count"] for row in chat.json_layouts(made, "line").collect()}
    assert counts == {"prompt_response": 2, "messages": 3, "from_value": 1, "instruction_only": 1, "system_prompt": 1, None: 5}


# 8 language


def test_language_held_out_accuracy(spark, documents):
    truth = {row.doc_id: row.lang for row in documents.collect()}
    rows = queries.op8_language(spark, SMALL).collect()
    held = [row for row in rows if row.held_out]
    assert len(rows) == len(truth) and len(held) > 30
    assert sum(row.lang_pred == truth[row.doc_id] for row in held) >= 0.98 * len(held)


def test_code_lengths_equal_brute_force(spark):
    samples = {"aa": "abra cadabra abra", "bb": "bonobo bob boo cab"}
    made = spark.createDataFrame([(lang, text) for lang, text in samples.items()], "lang string, text string")
    model = langid._prepared(langid.fit(langid.gram_counts(made)))
    edge = bytes([255]) * langid.ORDER

    def bits(lang, data, i):
        train = edge + samples[lang].encode()
        total = 0.0
        for k in range(langid.ORDER, -1, -1):
            after = Counter(train[j] for j in range(langid.ORDER, len(train)) if train[j - k : j] == data[i - k : i])
            n, q = sum(after.values()), len(after)
            if after[data[i]]:
                return total + math.log2((n + q) / after[data[i]])
            total += math.log2((n + q) / q) if q else 0
        return total + 8

    data = edge + b"abba cob?"
    grams = np.array([int.from_bytes(data[i - 3 : i + 1], "big") for i in range(3, len(data))], np.uint64)
    got = langid.code_lengths(grams, model)
    want = [[bits(lang, data, i) for lang in model["names"]] for i in range(3, len(data))]
    assert np.allclose(got, want, atol=1e-4)


# 9 quality


def test_counts_equal_brute_force(spark, texts):
    for row in queries.op9_quality(spark, SMALL).collect():
        text = texts[row.doc_id]
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(windows)
        repeated = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert want == (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert row.base_failed == failed and not (failed and row.kept)


def test_clean_documents_stay_and_junk_goes(spark):
    labels = {row.doc_id: row.quality for row in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [row for row in queries.op9_quality(spark, "/root/testdata/sf0.01").collect() if row.doc_id in labels and not row.base_failed]
    clean, junk = ([row for row in rows if labels[row.doc_id] == value] for value in (1, 0))
    assert sum(row.kept for row in clean) >= 0.99 * len(clean)
    assert sum(row.kept for row in junk) <= 0.05 * len(junk)


def test_expectation_maximisation_finds_planted_rules():
    good = (1,) * len(quality.RULES)
    patterns = [(good, 900), ((0,) + good[1:], 50)] + [(good[:j] + (-1,) + good[j + 1 :], 10) for j in range(len(good))]
    model = quality.fit(patterns)
    assert model["share"][0] > 0.9
    assert all(model[name, -1][0] <= 0.002 and model[name, -1][j + 1] >= 0.9 for j, name in enumerate(quality.RULES))


def drawn_patterns(number, errors, bad_share=0.0, hits=None):
    rng = np.random.default_rng(7)
    votes = np.where(rng.random((number, len(errors))) < errors, -1, 1)
    bad = rng.random(number) < bad_share
    if hits is not None:
        votes[bad] = np.where(rng.random((bad.sum(), len(errors))) < hits, -1, 1)
    distinct, counts = np.unique(votes, axis=0, return_counts=True)
    return [(tuple(map(int, pattern)), int(n)) for pattern, n in zip(distinct, counts)]


@pytest.mark.parametrize("number", [20_000, 500_000])
def test_one_error_among_good_votes_is_no_verdict(spark, number):
    model = quality.fit(drawn_patterns(number, np.array([0.001, 0.002, 0.005, 0.01, 0.02, 0.03, 0.05])))
    one = [tuple(-1 if i == j else 1 for i in range(len(quality.RULES))) for j in range(len(quality.RULES))]
    made = spark.createDataFrame(one, [f"_vote_{name}" for name in quality.RULES])
    assert all(row[0] > 0.5 for row in made.select(quality.posterior_good(model)).collect())


@pytest.mark.parametrize("number", [20_000, 500_000])
def test_planted_rates_are_found(number):
    errors, hits = np.array([0.01, 0.02, 0.03, 0.05, 0.1, 0.02, 0.01]), np.array([0.8, 0.7, 0.6, 0.75, 0.9, 0.5, 0.85])
    model = quality.fit(drawn_patterns(number, errors, 0.2, hits))
    assert abs(model["share"][-1] - 0.2) < 0.02
    for j, name in enumerate(quality.RULES):
        assert abs(model[name, -1][0] - errors[j]) < 0.01 and abs(model[name, -1][-1] - hits[j]) < 0.05


# 10 sharding


def test_shards_and_places(spark, texts):
    rows = queries.op10_sharding(spark, SMALL).collect()
    slots = defaultdict(list)
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= row.shard < 24 and row.grown_shard in (row.shard, 24)
        slots[row.shard].append(row.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_weights_hold_and_moves_stay_in_changed_subtrees(spark):
    keys = spark.range(20_000)
    tree = [sharding.Shard("r0", "a", 0, 1.0), sharding.Shard("r0", "a", 1, 1.0), sharding.Shard("r0", "b", 2, 2.0), sharding.Shard("r1", "c", 3, 4.0)]
    heavier = [*tree[:3], sharding.Shard("r1", "c", 3, 8.0)]
    inside = [*tree[:1], sharding.Shard("r0", "a", 1, 3.0), *tree[2:]]
    df = keys
    for name, shape in (("base", tree), ("heavier", heavier), ("inside", inside)):
        df = sharding.with_shard(df, F.col("id"), shape, name)
    rows = df.collect()
    counts = Counter(row.base for row in rows)
    assert all(abs(counts[shard.number] / 20_000 - shard.weight / 8) < 0.015 for shard in tree)
    assert all(row.heavier == 3 for row in rows if row.heavier != row.base)
    # rack a gained weight, and with it its region: rows come into the region, and inside it only into rack a
    moved = [row for row in rows if row.inside != row.base]
    assert moved and all(row.inside in (0, 1) or row.base == 3 and row.inside == 2 for row in moved)


def test_a_worker_codes_a_gram_once(monkeypatch):
    """Kept code lengths equal those worked out anew, within the limit and beyond it, for all chunks."""
    rng, asked = np.random.default_rng(5), Counter()
    plain = ctw._code_lengths
    keys, p, own = kernels.in_order(np.array([ctw._node_key(0, np.zeros(1, np.uint64), np.array([n]))[0] for n in range(1, 200)]), rng.random(199), np.ones(199))
    cache = {"nodes": kernels.Lookup(keys), "p1": p, "own": own}

    def counting(grams, *rest):
        asked.update(grams.tolist())
        return plain(grams, *rest)

    monkeypatch.setattr(ctw, "_code_lengths", counting)
    chunks = [np.unique(rng.integers(0, 900, 200).astype(np.uint64)) for _ in range(12)] + [np.array([0, 2**64 - 1], np.uint64)] * 2 + [np.zeros(0, np.uint64)]
    for most, once in ((1 << 19, True), (300, False)):
        monkeypatch.setattr(ctw, "CODES_KEPT", most)
        cache.pop("codes", None)
        asked.clear()
        for grams in chunks:
            for got, wanted in zip(ctw._kept_code_lengths(grams, cache, 4), plain(grams, cache, 4)):
                assert np.array_equal(got, wanted)
            assert len(cache["codes"][0]) <= max(most, 200) and np.array_equal(cache["codes"][0], np.unique(cache["codes"][0]))
        assert (max(asked.values()) == 1) == once


@pytest.mark.parametrize("held", [2, 64, 1 << 20])
def test_a_task_adds_up_its_counts(spark, monkeypatch, held):
    """Counts by gram and word are those of all texts, and a task that can hold them hands on each key once."""
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 16)
    monkeypatch.setattr(ctw, "COUNTS_HELD", held)
    texts = ["the cat sat on the mat", "the cat ran", "", None, "on on on on", "the cat sat on the hat"] * 3
    grams = Counter((b"\xff" * 4 + (t or "").encode() + b"\xff")[i : i + 5] for t in texts for i in range(len((t or "").encode()) + 1))
    made = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    rows = ctw.counted(made).collect()
    assert {row.key: row.n for row in rows if row.kind == ctw._GRAM} == {int.from_bytes(gram, "big"): n for gram, n in grams.items()}
    words = Counter(word for t in texts for word in (t or "").split())
    assert sorted(row.n for row in rows if row.kind == ctw._WORD) == sorted([*words.values(), len(texts)])
    if held == 1 << 20:
        handed = []
        monkeypatch.setattr(type(made), "groupBy", lambda self, *keys: handed.append(self) or type("", (), {"agg": lambda *_: self})())
        assert ctw.counted(made).count() == len(rows)
