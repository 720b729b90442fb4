"""Prefix tries, quality scores and phrase collocations against brute force, and their edges."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import phrases, quality, tries
from shelfscope.llm.common import prepare
from tools.compare import frame_hash

SYL = "ba ne ti ro sa mu le ko pi da re no va lu".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYL, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture
def many_tasks(spark):
    """No merging of small partitions, so ranges really end inside groups."""
    prepare(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# -- tries ------------------------------------------------------------------------------------

def sequences(rng, n):
    """Conversations as lists of (role, text): shared beginnings, copies, empty and long ones."""
    pool = [("user", prose(rng, 3)) for _ in range(6)] + [("", ""), (None, None), ("bot", "é" * 3)]
    out = {}
    for c in range(n):
        turns = [rng.choice(pool[:3]) for _ in range(rng.randint(0, 3))] + [rng.choice(pool) for _ in range(rng.randint(0, 4))]
        out[c] = turns
    for c in range(n, n + 40):
        out[c] = [pool[0], pool[1]]                          # a large group of equal ones
    out[n + 40] = [pool[0], pool[1]] * 15
    out[n + 41] = [pool[0], pool[1]] * 15 + [pool[2]]
    out[n + 42] = [pool[0], pool[1]] * 8
    return {c: [(r or "", t or "") for r, t in ts] for c, ts in out.items()}


def slow_trie(seqs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    kids = Counter(k[:-1] for k in members if k)
    out = {}
    leaves, saved = Counter(), Counter()
    for k in members:
        own = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own
            leaves[k[:d]] += kids[k] == 0
    for k, m in members.items():
        out[(min(m), len(k))] = (min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                                 hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
    assert len(out) == len(members)
    return out


def as_turns(spark, seqs):
    def ident(r, t):
        return bytearray(hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()[:16])
    turns = [(c, len(s), i + 1, ident(*x), len(x[1].encode())) for c, s in seqs.items() for i, x in enumerate(s)]
    return (spark.createDataFrame(turns, "c long, m long, p long, id binary, bytes int").repartition(5),
            spark.createDataFrame([(c, len(s)) for c, s in seqs.items()], "c long, m long"))


@pytest.mark.parametrize("segment,block,piece", [(256, 1 << 22, 1 << 16), (256, 300, 20), (4, 600, 20), (1, 300, 1), (3, 1 << 20, 60)])
def test_trie_against_brute_force(spark, many_tasks, segment, block, piece):
    seqs = sequences(random.Random(segment), 90)
    got = tries.prefix_trie(*as_turns(spark, seqs), segment=segment, block_bytes=block, piece=piece).collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(found) == len(got)
    assert found == slow_trie(seqs)


def test_radix_tree_layouts_grow():
    rng = random.Random(1)
    tree, want, shapes = tries.Node(b""), {}, set()
    keys = [tries.ROOT + b"".join(bytes([rng.randrange(256)]) + bytes(15) for _ in range(rng.randint(0, 2))) for _ in range(400)]
    for i, key in enumerate(keys + [tries.ROOT + bytes(16) + bytes([b]) * 16 for b in range(30)]):
        if key not in want:
            want[key] = i
            tries.insert(tree, key, (1, i, True, [1] * 2, 0))
    rows = list(tries.emit(tree))
    shapes = {type(n.layout).__name__ for n in walk(tree)}
    assert shapes == {"Few", "Indexed", "Full"}
    prefixes = {k[:e] for k in want for e in range(16, len(k) + 1, 16)}
    assert len(rows) == len(prefixes) and {r[0] for r in rows} == {tries.node_id(p) for p in prefixes}
    root = next(r for r in rows if r[0] == tries.ROOT)
    assert root[4] == len(want) and root[6] == len({k[:32] for k in want if len(k) > 16})


def walk(node):
    yield node
    for _, child in node.layout.children():
        yield from walk(child)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, c string").repartition(4)


def slow_rebuild(rows):
    """Tied turns go by role, then the turn's hash, as documented."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, r, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16], x))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def test_op11_on_odd_rows(spark, many_tasks):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice([prose(rng, 2), "hi", "", None]))
            for c in range(60) if c not in (10, 25) for t in rng.sample([None, *range(12)], rng.randint(1, 12))]
    rows += [(7, 3, "user", "tie"), (7, 3, "bot", "tie"), (7, 3, "bot", "tie"), (7, None, None, None), (None, 0, "user", "lost"),
             (61, 0, "user", "long " * 30_000)] + [(70, t, "user", "a") for t in range(600)] + [(75, t, "user", "a") for t in range(600)]
    turns, sizes = tries.rebuilt(tries.ordered(conversations(spark, rows)))
    got = tries.prefix_trie(turns, sizes).collect()
    found = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert found == slow_trie(slow_rebuild(rows)) and len(found) == len(got)
    none = conversations(spark, rows).limit(0)
    assert tries.prefix_trie(*tries.rebuilt(tries.ordered(none))).count() == 0


# -- collocations ------------------------------------------------------------------------------

def slow_collocations(rows, least=10, contained=50, top=2000):
    f, n, short = defaultdict(Counter), Counter(), str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(short)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, g in f.items():
        cand = {p: a for p, a in g.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * cand[q] >= contained * a for q in cand if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            s, k = min((1000000 * a * a // (g[p[:k]] * g[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), g[p[:k]], g[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def phrase_rows(rng):
    vocabulary = [prose(rng, 1) for _ in range(25)] + ["É", "été", "Über", "a\u00a0b", "x" * 3000]
    fixed = [" ".join(rng.choices(vocabulary, k=9)) for _ in range(4)]
    out = []
    for i in range(160):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) + rng.choice([".", ",", "\n", "\t", ";  ", "!?", "\r\n", "\x0b"])
                 for _ in range(rng.randint(0, 6))]
        if i % 4 == 0:
            parts.append(rng.choice(fixed).upper())
        out.append(("".join(parts), ["en", "en", "de", None, "und"][i % 5]))
    return out + [(None, "en"), ("", "de"), (" \t ", None), ("de la " * 200_000, "en"), ("the cat " * 40, "fr"), ("the cat " * 40, "fr")]


@pytest.mark.parametrize("top", [2000, 7])
def test_collocations_against_brute_force(spark, many_tasks, top):
    rows = phrase_rows(random.Random(4))
    df = spark.createDataFrame([(i % 3, *r, "p", 1) for i, r in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n int").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, top=top).collect())
    assert got == slow_collocations(rows, top=top)
    assert any(len(r[2].split(" ")) == 3 for r in got)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_compacted_paths(spark):
    prepare(spark)
    edges = [("a b c", 12), ("b c d", 12), ("c d e", 12), ("d e f", 20), ("x d e", 8), ("p q r", 10)]
    pairs = [("a b", 12), ("b c", 12), ("c d", 12), ("d e", 20), ("e f", 20), ("x d", 8), ("p q", 30), ("q r", 10)]
    e, p = (spark.createDataFrame([("en", *x) for x in rows], "lang string, phrase string, n long") for rows in (edges, pairs))
    got = {(" ".join(r.words), r.a, r.open_left, r.open_right) for r in phrases.compacted(e, p).collect()}
    assert got == {("a b c d e", 12, False, False), ("d e f", 20, False, False), ("x d e", 8, False, False), ("p q r", 10, False, False)}


def test_collocations_of_long_paths(spark, many_tasks, monkeypatch):
    monkeypatch.setattr(phrases, "PATH", 3)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    rows = [(" ".join(words), "en")] * 11 + [(" ".join(words[5:9]), "en")] * 3 + [(" ".join(rng.choices(words, k=30)), "en") for _ in range(6)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == slow_collocations(rows)


def test_exact_scores(spark):
    df = spark.createDataFrame([(123_456_789_012, 123_456_789_013, 987_654_321_987)], "a long, l long, r long")
    a, l, r = 123_456_789_012, 123_456_789_013, 987_654_321_987
    assert df.select(phrases.score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (l * r)


def test_a_batch_with_a_very_large_vocabulary(monkeypatch):
    rng = random.Random(3)
    rows = []
    for limit in (1 << 21, 4):
        monkeypatch.setattr(phrases, "VOCABULARY", max(limit, 1 << 21) if limit > 4 else limit)
        numbers = phrases.Numbers()
        ids = np.array([numbers[b"w%d" % rng.randrange(9)] if i % 7 else 0 for i in range(200)])
        rng = random.Random(3)
        out = [(x[1], *phrases.bucket_counts([x[2]], [x[3]], [x[4]], [x[5]])) for x in phrases.blocks("en", numbers, ids, 2)]
        rows.append(sorted((b, words.take(pa.array(k)).to_pylist(), int(w)) for b, words, key, weight in out for k, w in zip(key, weight)))
        rng = random.Random(3)
    assert rows[0] == rows[1]


# -- quality -----------------------------------------------------------------------------------

def all_tokens(texts):
    """Bucket lists per text."""
    out = [[] for _ in texts]
    for doc, ids in quality.tokens(texts):
        for d, i in zip(doc.tolist(), ids.tolist()):
            out[d].append(i)
    return out


def slow_vectors(texts):
    place, sign = quality.index_vectors()
    v = np.zeros((1 << quality.BITS, quality.DIM))
    for ids in all_tokens(texts):
        for i, a in enumerate(ids):
            for j in range(max(0, i - quality.WINDOW), min(len(ids), i + quality.WINDOW + 1)):
                if i != j:
                    for k in range(quality.SIGNS):
                        v[a, place[ids[j], k]] += sign[ids[j], k]
    return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1)


def labelled(spark, n=300):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, rng.randint(20, 80))
        rows.append((i, " ".join(w + "###" for w in text.split()) if bad and i % 8 else text.upper() if bad else text, int(not bad)))
    return rows, spark.createDataFrame([(i, t, "en", "k") for i, t, _ in rows], "doc_id long, text string, lang string, score string").repartition(3), \
        spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")


def test_word_vectors_against_brute_force(spark):
    prepare(spark)
    rows, docs, _ = labelled(spark, 40)
    odd = docs.unionByName(spark.createDataFrame([(900, None, "en", "k"), (901, "", "en", "k"), (902, "AB ab ab 12 __ #!", None, None)], docs.schema))
    texts = [r[1] for r in rows] + [None, "", "AB ab ab 12 __ #!"]
    want = slow_vectors(texts)
    assert np.allclose(quality.word_vectors(odd), want, atol=1e-6)
    x = quality.pooled(texts, want.astype(np.float32))
    for ids, v in zip(all_tokens(texts), x):
        assert np.allclose(v, np.mean([want[i] for i in ids], axis=0) if ids else 0, atol=1e-6)


def slow_tokens(text):
    """Tokens as texts, with the marks' buckets between them."""
    kinds = "space letter digit line sign".split()
    kind = lambda x: kinds[quality.KIND[ord(x)]] if ord(x) < 1 << 16 else "sign"
    out, before, i = [], None, 0
    while i < len(text):
        j = i
        while j < len(text) and kind(text[j]) == kind(text[i]):
            j += 1
        t, i = text[i:j], j
        if kind(t[0]) == "space":
            continue
        low = "".join(x.lower() if len(x.lower()) == 1 else x for x in t)
        out.append(low)
        if low == before:
            out.append(quality.REPEAT)
        if len(t) > 1 and all(x.isupper() for x in t):
            out.append(quality.CAPITALS)
        before = low
    return out


@pytest.mark.parametrize("stretch", [1 << 18, 5])
def test_tokens_against_brute_force(monkeypatch, stretch):
    monkeypatch.setattr(quality, "STRETCH", stretch)
    rng = random.Random(12)
    texts = ["".join(rng.choice("aaBB1_#! \n\u00a0\u00e9\u00c9\u00bd\u0301\u0130x\U0001f600") for _ in range(rng.randint(0, 40)))
             for _ in range(400)] + [None, "", " ", "ab " * 50]
    number = {}
    for text, ids in zip(texts, all_tokens(texts)):
        want = slow_tokens(text or "")
        assert len(ids) == len(want)
        for w, i in zip(want, ids):
            assert number.setdefault(w, i) == i if isinstance(w, str) else w == i
    assert len(set(number.values())) >= len(number) - 1 and len(number) > 80


def test_network_gradient_and_temperature():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = (np.abs(x[:, 0]) + 0.05 * rng.normal(size=2000) > 0.7).astype(float)     # needs the hidden layer
    back = np.arange(2000) % 5 == 0
    net = quality.fit(x, y, back)
    z = quality.forward(x[back], net)
    assert ((z > 0) == (y[back] > 0)).mean() > 0.9
    raw = z * net[-1]
    assert quality.loss(z, y[back]) <= min(quality.loss(raw / t, y[back]) for t in (0.5, 1, 2, 4)) + 1e-3


def test_op12_scores(spark):
    prepare(spark)
    rows, docs, labels = labelled(spark)
    odd = [(900, None, "en", "k"), (901, "", "en", "k"), (902, "... --", "en", "k"), (None, "ba ne ti", "en", "k"), (1, rows[1][1], "en", "k"),
           (903, prose(random.Random(2), 60_000), None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (1, 1), (4000, 0)], labels.schema))
    vectors = quality.word_vectors(docs)
    net = quality.train(docs, labels, vectors, where=~quality.held_out())
    got = quality.scored(docs, vectors, net).withColumn("held_out", quality.held_out()).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    want = {i: q for i, _, q in rows}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 30 and sum((r.score >= quality.GOOD) == want[r.doc_id] for r in held) >= 0.95 * len(held)
    again = quality.scored(docs, vectors, quality.train(docs, labels, quality.word_vectors(docs.repartition(5)), where=~quality.held_out()))
    assert sorted((r.doc_id or -1, r.score) for r in got) == sorted((r.doc_id or -1, r.score) for r in again.collect())


def test_op12_without_labels_or_rows(spark):
    prepare(spark)
    _, docs, labels = labelled(spark, 12)
    vectors = quality.word_vectors(docs.limit(0))
    assert not vectors.any()
    assert quality.train(docs, labels.limit(0), vectors) == 0.5
    assert quality.train(docs, labels.where("quality = 1"), vectors) == 1.0
    assert {r.score for r in quality.scored(docs, vectors, 0.5).collect()} == {0.5}
    assert quality.scored(docs.limit(0), vectors, 0.5).count() == 0


def test_twins(spark):
    """The registered queries against their SQL on the smallest tables."""
    from shelfscope.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("op11_tries", "op13_collocations"):
        got, want = QUERIES[name](spark, sf).toPandas(), con.execute(ORACLE[name]).df()
        assert len(got) == len(want) > 0 and frame_hash(got)[0] == frame_hash(want)[0]
