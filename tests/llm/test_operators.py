"""The training-data operators against brute force, and their defined results at the edges."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfscope.llm import langid, mixing, outliers, packing, pages, queries, repeats, secrets, simhash, toxicity, vectors
from shelfscope.llm.common import components, prepare

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYL = "ba ne ti ro sa mu le ko pi da re no va lu".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYL, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Clean texts, copies, near copies, nulls, blanks, ties, one very long text, a clashing
    column; one source holds most rows."""
    prepare(spark)
    rng = random.Random(5)
    base = [prose(rng, rng.randint(5, 160)) for _ in range(60)]
    rows = [(i, t, ["en", "de"][i % 2], "hot" if i % 3 else f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + k, base[3], "en", "hot") for k in range(40)]
    rows += [(200 + k, base[5] + " " + prose(rng, 1), None, "hot") for k in range(30)]
    rows += [(300, None, "en", None), (301, "", "en", "s1"), (302, " \t\n ", None, None), (303, "42 !!", "de", "s2"),
             (304, prose(rng, 30_000), "en", "long"), (0, base[0], "en", "s0"), (305, base[9][:150] + "é中" + base[9], "de", "hot"),
             (306, "a b", "en", "hot"), (307, "A  b", "en", "hot"), (308, "x" * 5000, "en", "hot")]
    return spark.createDataFrame([(*r, i, "k") for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, size int, key string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def given(docs):
    return rows_of(docs.select("doc_id", "text", "lang", "source"))


# -- shared -----------------------------------------------------------------------------------

def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


# -- 9 SimHash ----------------------------------------------------------------------------------

def slow_fingerprint(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    s = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(docs):
    got = {(i, format(f & (1 << 64) - 1, "016x"), c) for i, f, c in rows_of(simhash.simhash_groups(docs))}
    data = [(i, slow_fingerprint(t)) for i, t, *_ in given(docs)]
    comp = list(range(len(data)))
    for _ in data:
        new = [min(comp[j] for j in range(len(data)) if (data[i][1] ^ data[j][1]).bit_count() <= 3) for i in range(len(data))]
        if new == comp:
            break
        comp = new
    first = {c: min(data[j][0] for j in range(len(data)) if comp[j] == c) for c in set(comp)}
    assert got == {(i, format(f, "016x"), first[comp[k]]) for k, (i, f) in enumerate(data)}
    assert len(rows_of(simhash.simhash_groups(docs))) == docs.count()


def test_covering_masks_cover_every_near_pair():
    masks = simhash.covering_masks(64, 3)
    rng = random.Random(1)
    assert len(masks) == 15
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(diff & m == 0 for m in masks)


def test_simhash_links_all_pairs_across_blocks(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(3000)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = components(simhash.near_links(df))
    assert got.select("component").distinct().count() == 1 and got.count() == len(fps)


# -- 8 language ID ---------------------------------------------------------------------------------

def test_langid_held_out_accuracy_and_edges(spark, docs, empty):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(queries.QUERIES["op8_langid"](spark, SF).join(d.select("doc_id", "lang"), "doc_id").select(
        "held_out", "lang", "lang_pred", "score"))
    out = [g for g in got if g[0]]
    assert len(out) > 30 and sum(g[1] == g[2] for g in out) / len(out) > 0.95
    assert all(0 <= g[3] <= 1 for g in got)
    m = langid.train(docs)
    assert m[0] == ["de", "en"]
    res = defaultdict(set)
    for i, p, s in rows_of(langid.predict(docs, m, ["doc_id"])):
        res[i].add(p)
    assert all(res[i] == {"und"} for i in (300, 301, 302, 303)) and res[304] <= {"en", "de"}
    none = langid.train(empty)
    assert none[0] == [] and {r[1] for r in rows_of(langid.predict(docs, none, ["doc_id"]))} == {"und"}
    assert rows_of(langid.predict(empty, m, ["doc_id"])) == []


def test_langid_is_multinomial_bayes(docs):
    """The distributed model equals a plain count of the same n-grams."""
    names, prior, logp = langid.train(docs)
    count = {n: np.full(len(langid.ORDERS) << langid.BITS, 0.1) for n in names}
    n_docs = Counter()
    for _, t, lang, _ in given(docs):
        if lang and t is not None:
            n_docs[lang] += 1
            for g in langid.ngrams([t])[0]:
                np.add.at(count[lang], g, 1)
    for k, n in enumerate(names):
        assert prior[k] == pytest.approx(np.log(n_docs[n] / sum(n_docs.values())))
        for o in range(len(langid.ORDERS)):
            part = slice(o << langid.BITS, (o + 1) << langid.BITS)
            assert np.allclose(logp[k][part], np.log(count[n][part] / count[n][part].sum()), atol=1e-4)


# -- 7 secrets ---------------------------------------------------------------------------------------

def slow_spans(t):
    pats = [("assign", r'''((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)'''),
            ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]
    out = []
    for k, (name, p) in enumerate(pats):
        for m in re.finditer(p, t, re.A):
            if (k == 0 and len(m[2]) >= 6) or (k == 1 and len(m[0]) >= 20) or (k == 2 and len(m[0]) >= 24):
                out.append((m.start(), k, m.end(), name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


def test_secret_base_spans(spark, docs):
    texts = ["token: token: abcdefgh", "PassWord = 'hunter22!' api_key:abc", "é中 AKIA" + "Z9" * 10 + " x", "0" * 30 + "g" + "a" * 23,
             "AKIAAKIA12", "secret=" + "0af" * 20, "none", "", " ".join(f"token={i:06d}" for i in range(900))]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(99, None, "x")], "doc_id long, text string, base string")
    got = {i: b for i, b in rows_of(secrets.scan(d.select("doc_id", "text"), [0.0] * secrets.SIZE ** 2)
                                    .select("doc_id", secrets.joined("base")))}
    assert got == {**{i: slow_spans(t) for i, t in enumerate(texts)}, 99: ""}
    q = {r["doc_id"]: r for r in queries.QUERIES["op7_secrets"](spark, SF).collect()}
    for i, t in rows_of(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")):
        assert q[i]["base_sha256"] == hashlib.sha256(slow_spans(t or "").encode()).hexdigest()
    red = {r["doc_id"]: r for r in secrets.redacted(d).collect()}
    assert red[0]["text"] == "token: token: abcdefgh" and red[99]["text"] is None and red[3]["base"] == "x"
    assert red[5]["text"] == "[SECRET]" and red[6]["text"] == "none"


def test_markov_spans(spark, empty):
    rng = random.Random(4)
    rows = [(i, prose(rng, 60) + (f' token="{rng.getrandbits(160):040x}"' if i % 2 else "")) for i in range(60)]
    strange = "".join(rng.choices("0123456789ABCDEFGHJKXZQW", k=32))
    rows += [(1000, f"see {strange} here"), (1001, "see " + "batinero" * 4 + " here")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.train(d)
    got = dict(rows_of(secrets.scan(d, model).select("doc_id", secrets.joined("spans"))))
    assert got[1000] == "markov:4:36" and got[1001] == "" and got[1].startswith("assign:")
    assert set(secrets.train(empty)) == {0.0} and rows_of(secrets.scan(empty, model)) == []


# -- 2 mixing -----------------------------------------------------------------------------------------

def test_mixing(docs, empty):
    got = rows_of(mixing.mix(docs, bucket_rows=7).select("doc_id", "source", "size", "source_size", "target", "taken", "copies"))
    size = Counter()
    for i, t, _, s in given(docs):
        size[s] += len(WORD.findall(t or ""))
    names = sorted(s for s in size if s is not None) + [None]
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    capped: set = set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(w[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and level * w[s] >= 3 * size[s]}
        if not more:
            break
        capped |= more
    taken = Counter()
    for i, s, n, total, target, take, copies in got:
        assert total == size[s] and take == n * copies and take <= 3 * n
        assert target == pytest.approx(3 * size[s] if s in capped else level * w[s])
        taken[s] += take
    for s in names:                                    # whole documents: half the largest one is the worst
        assert abs(taken[s] - next(g[4] for g in got if g[1] == s)) <= max(g[2] for g in got if g[1] == s) / 2
    assert len(got) == docs.count()
    assert sorted(got, key=str) == sorted(rows_of(mixing.mix(docs, bucket_rows=7).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "copies")), key=str)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert rows_of(mixing.mix(empty)) == []


def test_mixing_prefers_heavy_documents(spark):
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    heavy = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.25)
    other = spark.createDataFrame([(9000 + i, "a b c d", "t") for i in range(1000)], "doc_id long, text string, source string")
    got = mixing.mix(d.unionByName(other), weight=heavy, weights=(1, 1), most=3.0).where("source = 's'")
    n = dict(rows_of(got.groupBy(F.col("doc_id") % 2 == 0).agg(F.sum("copies"))))
    assert n[True] > 1.5 * n.get(False, 0)


def test_mixing_fills_the_gap_behind_long_documents(spark):
    rng = random.Random(12)
    rows = [(i, "a " * rng.choice((3, 5, 8, 13, 21, 700, 900)), f"s{i % 4}") for i in range(240)]
    rows += [(i, "a " * 50, None) for i in range(1000, 1010)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(mixing.mix(d, bucket_rows=9).select("doc_id", "source", "size", "target", "copies"))
    u = {r[0]: r[1] for r in rows_of(d.select("doc_id", (F.shiftrightunsigned(F.xxhash64(F.lit(20), "doc_id"), 11) + 0.5)))}
    for s in ("s0", "s1", "s2", "s3", None):
        mine = sorted((g for g in got if g[1] == s), key=lambda g: -u[g[0]])
        total, target = sum(g[2] for g in mine), mine[0][3]
        epochs = int(target // total)
        gap, want, left = target - epochs * total, {}, []
        for g in mine:                                  # each in turn, taken if it fits
            fits = g[2] <= gap
            want[g[0]] = epochs + fits
            gap -= g[2] * fits
            left += [g] * (not fits)
        miss, k = min(((abs(gap - g[2]), i) for i, g in enumerate(left)), default=(gap, 0))
        if miss < gap:
            want[left[k][0]] += 1
        assert {g[0]: g[4] for g in mine} == want


# -- 10 packing ----------------------------------------------------------------------------------------

def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    got = rows_of(packing.pack(docs))
    seq = defaultdict(list)
    by = defaultdict(Counter)
    for i, start, n, crc, total, s, at in got:
        seq[s].append((at, n))
        by[i][start, n, crc, total] += 1
    for s in seq.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    want = defaultdict(Counter)
    for i, t, *_ in given(docs):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for lo in range(0, len(ids), 2048):
            part = np.array(ids[lo:lo + 2048], "<u4")
            want[i][lo, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert by == want
    assert rows_of(packing.pack(empty)) == []


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tok, enc = Tokenizer.from_file(path), packing.tokenizer(path)
    rng = random.Random(8)
    texts = ["", " ", "a  b", "\n\na\n b", "it's 12x <|endoftext|> z", " é x", "tab\tx\r\ny", "a\n", " lead", "中文 text"]
    texts += ["".join(rng.choices("ab 'é1\n.,", k=40)) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(enc(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_a_text_is_encoded_in_one_call(monkeypatch):
    """A call for each new word cost more than the whole text does."""
    import tiktoken
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tok, calls = Tokenizer.from_file(path), []

    def counted(f):
        return lambda self, text, **k: calls.append(len(text)) or f(self, text, **k)

    for name in ("encode", "encode_ordinary", "encode_to_numpy"):
        monkeypatch.setattr(tiktoken.Encoding, name, counted(getattr(tiktoken.Encoding, name)))
    enc, rng = packing.tokenizer.__wrapped__(path), random.Random(12)
    points = [*range(1, 0x600), *range(0x2000, 0x2100), *range(0x4E00, 0x4F00), *range(0x1F300, 0x1F700)]
    texts = [prose(rng, 2000), "a b\n" * 500, "end of it " + "<|endoftext|>" * 3 + "  ", " " * 3000, "x" + "\u3000\u00a0 " * 50]
    texts += ["".join(map(chr, rng.choices(points, k=200))) for _ in range(200)]
    for t in texts:
        del calls[:]
        assert np.frombuffer(enc(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
        assert calls == [len(t)]


def test_cutting_stock_is_near_the_bound():
    rng = np.random.default_rng(3)
    d = np.bincount(rng.integers(1, 65, 3000), minlength=65)
    plan = packing.solve(d)
    held = np.zeros(65, int)
    for n, p in plan:
        assert sum(c * a for c, a in p.items()) <= 64
        for c, a in p.items():
            held[c] += n * a
    assert (held == d).all()
    assert sum(n for n, _ in plan) <= 1.01 * (d * np.arange(65)).sum() / 64 + 2
    assert packing.solve(np.zeros(65, int)) == []


# -- 5 quality ------------------------------------------------------------------------------------------

def test_statistics(spark, docs):
    extra = [(500, "one two three four five six seven eight " * 5 + "end\nline\n\n line\nline\n \t\nline", "en", "s1"),
             (501, "a | b <c> #$%&* " * 9, "en", "s1"), (502, "x\x0by\x0cz\rq", "en", "s1")]
    d = docs.select("doc_id", "text", "lang", "source").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string, source string"))
    got = Counter(rows_of(outliers.text_statistics(d).withColumn("bad", outliers.base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "bad")))
    want = Counter()
    for i, t, *_ in given(d):
        t = t or ""
        w = WORD.findall(t)
        seen = defaultdict(list)
        for k in range(len(w) - 7):
            seen[tuple(w[k:k + 8])].append(k)
        rep = {k + j for v in seen.values() if len(v) > 1 for k in v for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
             len(w) < 20 or 100 * len(rep) > 30 * len(w)] += 1
    assert got == want


class SlowMcd:
    """The estimator by its description, over the cells of a group's vectors."""

    def __init__(self, x, parent=None, prior=100.0, cutoff=40.0):
        cell = {}
        for row in np.asarray(x):
            cell.setdefault(tuple(np.floor(row * np.array(outliers.RESOLUTION)).astype(int)), []).append(row)
        self.cells = [np.array(v) for v in cell.values()]
        self.mean = np.array([v.mean(axis=0) for v in self.cells])
        self.n = np.array([len(v) for v in self.cells])
        self.prior = prior
        med = np.array([self.middle(self.mean[:, i]) for i in range(4)])
        var = np.array([max(1.4826 * self.middle(abs(self.mean[:, i] - med[i])), outliers.FLOOR[i]) ** 2 for i in range(4)])
        self.above = (parent.m, parent.c, parent.scale) if parent else (med, np.diag(var), 1.0)
        order = sorted(range(len(self.n)), key=lambda i: (self.n[i], *self.mean[i]))
        starts = [(med, np.diag(var)), self.moments(range(len(self.n))), (self.mean[order[-1]], np.diag(var))]
        ends = []
        for m, c in starts:
            for _ in range(100):
                d, upto, pick = self.d2(m, c), 0, []
                for i in np.argsort(d, kind="stable"):
                    if upto < len(x) * 0.5:
                        pick.append(i)
                        upto += self.n[i]
                nm, nc = self.moments(pick)
                if np.allclose(nm, m, atol=1e-9) and np.allclose(nc, c, atol=1e-9):
                    break
                m, c = nm, nc
            low = self.factor(0.5 * c + 0.5 * np.diag(var))
            ends.append((round(np.log(np.diag(low)).sum(), 6), len(ends), m, c))
        _, _, m, c = min(ends, key=lambda e: e[:2])
        d = self.d2(m, c)
        self.m, self.c = self.moments(np.flatnonzero(d <= cutoff * self.scaled(d)))
        self.scale = self.scaled(self.d2(self.m, self.c))

    def scaled(self, d):
        n, own = self.n.sum(), max(1.0, self.middle(d) / outliers.CHI2_MEDIAN)
        return np.exp((n * np.log(own) + self.prior * np.log(self.above[2])) / (n + self.prior))

    def middle(self, v):
        by = np.argsort(v, kind="stable")
        return v[by][np.searchsorted(np.cumsum(self.n[by]), self.n.sum() / 2)]

    def moments(self, pick):
        y, (pm, pc, _) = np.concatenate([np.zeros((0, 4)), *[self.cells[i] for i in pick]]), self.above
        w = len(y) + self.prior
        m = (y.sum(axis=0) + self.prior * pm) / w
        return m, (y.T @ y + self.prior * (pc + np.outer(pm, pm))) / w - np.outer(m, m)

    @staticmethod
    def factor(c):
        low = np.zeros((4, 4))
        for i in range(4):
            for j in range(i):
                low[i, j] = (c[i, j] - low[i, :j] @ low[j, :j]) / low[j, j]
            low[i, i] = np.sqrt(max(c[i, i] - low[i, :i] @ low[i, :i], outliers.FLOOR[i] ** 2))
        return low

    def d2(self, m, c, x=None):
        x = self.mean if x is None else np.asarray(x)
        return (np.linalg.solve(self.factor(c), (x - m).T) ** 2).sum(axis=0)


def test_outliers_follow_the_estimator(spark, empty):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(25, 120)), ["en", "de"][i % 3 == 0], ["a", "b", None][i % 7 % 3]) for i in range(260)]
    rows += [(900 + i, " ".join(w + "###%%%" for w in prose(rng, 50).split()), "en", "a") for i in range(12)]
    rows += [(990, "too short", "en", None), (991, None, "en", None), (992, prose(rng, 60), None, "few")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = {r["doc_id"]: r for r in outliers.verdicts(d).collect()}
    assert len(got) == len(rows)
    x, where = {}, {}
    for i, t, lang, source in rows:
        if i in (990, 991):
            continue
        w = WORD.findall(t)
        c = sum(map(len, w))
        x[i] = np.array([np.log(len(w)), np.log(c / len(w)), np.sqrt(len(re.findall(r"[#*$%&|<>]", t)) / c), 0.0])
        where.setdefault((lang, source), []).append(i)
    top = SlowMcd([x[i] for i in x])
    for lang in {g[0] for g in where}:
        mid = SlowMcd([x[i] for g, ids in where.items() if g[0] == lang for i in ids], top)
        for g, ids in where.items():
            if g[0] == lang:
                est = SlowMcd([x[i] for i in ids], mid)
                want = est.d2(est.m, est.c, [x[i] for i in ids]) / est.scale
                assert np.allclose([got[i]["d2"] for i in ids], want, rtol=1e-5)
    assert all(got[i]["kept"] == (i < 900 or i == 992) for i in x)
    assert not got[990]["kept"] and not got[991]["kept"] and got[990]["d2"] is None
    assert rows_of(outliers.verdicts(empty)) == []


@pytest.mark.parametrize("junk", [18, 24, 35])
def test_outliers_with_much_junk_of_one_kind(spark, junk):
    rng = random.Random(junk)
    rows = [(i, prose(rng, rng.randint(40, 90)), "en", "s") for i in range(200 - 2 * junk)]
    rows += [(1000 + i, " ".join(w + "###%%%" for w in prose(rng, 60).split()), "en", "s") for i in range(2 * junk)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in outliers.verdicts(d).collect()}
    assert [i for i, kept in got.items() if kept != (i < 1000)] == []


def test_outliers_in_small_groups(spark, empty):
    rng = random.Random(13)
    junk = lambda: " ".join(w + "###%%%" for w in prose(rng, 60).split())
    rows = [(i, prose(rng, rng.randint(40, 90)), "en", f"s{i % 20}") for i in range(200)]
    rows += [(500 + i, prose(rng, rng.randint(40, 90)), None, None) for i in range(8)]
    rows += [(900, junk(), "en", "s3"), (901, junk(), "en", "alone"), (902, junk(), None, None), (903, junk(), "xx", "few"),
             (990, "too short", "en", "s1"), (991, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in outliers.verdicts(d).collect()}
    assert len(got) == len(rows)
    assert all((r["d2"] is None) == (i >= 990) and r["kept"] == (i < 900) for i, r in got.items())
    few = outliers.verdicts(d.where("doc_id < 5 or doc_id = 900")).collect()
    assert len(few) == 6 and all(r["d2"] is not None and r["kept"] == (r["doc_id"] < 900) for r in few)
    assert rows_of(outliers.verdicts(empty)) == []


def test_native_operators_plan_no_python(spark):
    for name in ("op5_outliers", "op7_secrets"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# -- 1 toxicity ------------------------------------------------------------------------------------------

def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(2)
    n, width = 900, 6
    x = rng.integers(0, 3, (n, width))
    z = x @ np.array([2.0, -1, 0, 0, 1, 0]) + rng.logistic(size=n)
    grade = np.searchsorted([1.0, 3.0], z)
    row, col = np.nonzero(x)
    w, b = toxicity.fit_ordinal(row, col, x[row, col].astype(float), grade, width, rounds=600)
    assert (np.diff(b) > 0).all() and w[0] > w[4] > 0.4 > w[2] and w[1] < -0.4
    assert np.allclose(b, [1, 3], atol=0.6) and np.allclose(w, [2, -1, 0, 0, 1, 0], atol=0.4)


def test_gradient_matches_differences():
    """One Adam step moves every parameter against its numerical slope."""
    row, col, val = np.array([0, 1, 2, 3, 3]), np.array([0, 1, 0, 1, 0]), np.array([1.0, 2, 1, 1, 3])
    grade = np.array([0, 1, 2, 2])

    def loss(w, b):
        z = np.bincount(row, val * w[col], 4)
        up = np.column_stack([np.ones(4), toxicity.sigmoid(z[:, None] - b), np.zeros(4)])
        return -np.log(up[range(4), grade] - up[range(4), grade + 1]).mean()
    w0, b0 = toxicity.fit_ordinal(row, col, val, grade, 2, penalty=0, rounds=0)
    w1, b1 = toxicity.fit_ordinal(row, col, val, grade, 2, penalty=0, rounds=40)
    assert loss(w1, b1) < loss(w0, b0)
    for k in range(2):
        e = np.eye(2)[k] * 1e-5
        slope = (loss(w0 + e, b0) - loss(w0 - e, b0)) / 2e-5
        w, _ = toxicity.fit_ordinal(row, col, val, grade, 2, penalty=0, rounds=1)
        assert abs(slope) < 1e-6 or np.sign(w[k] - w0[k]) == -np.sign(slope)


def test_toxicity_scores_against_brute_force(spark):
    def features(text):
        ws = [w for w in re.split(r"[^a-z\u00e0-\u00ff]+", (text or "").lower()) if w]
        seed = xxhash.xxh64_intdigest("stem", 42)
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in ws] + [xxhash.xxh64_intdigest(w[:6], seed) for w in ws if len(w) > 6]
        return [h - (1 << 64) if h >> 63 else h for h in hashes]

    rng = random.Random(8)
    vocabulary = ["kind", "Reader", "garbage", "horrible", "horribly", "caf\u00e9", "of", "a"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 40))) + rng.choice([".", " 12!", ""]) for _ in range(60)]
    texts += [None, "", "... 12 34", "unknown words alone", "garbage " * 50_000]
    docs = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(texts)] + [(5, texts[5])], "doc_id long, text string")
    known = np.array(sorted(set(features("garbage horrible horribly caf\u00e9 kind"))), np.int64)
    w, b = np.linspace(-1, 1, len(known)), np.array([0.5, 1.25, 3.0])
    weight = dict(zip(known.tolist(), w))
    want = []
    for i, t in [*enumerate(texts), (5, texts[5])]:
        z = sum(weight[h] * (1 + math.log(n)) for h, n in Counter(features(t)).items() if h in weight)
        p = [1 / (1 + math.exp(k - z)) for k in b]
        want.append((-1 if i == 3 else i, sum(p), p[0]))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.severity, r.p_toxic) for r in toxicity.score(docs, (known, w, b)).collect())
    assert np.allclose(got, sorted(want), rtol=1e-9)


def test_toxicity_keeps_every_word_that_tells(spark):
    # more words than rows, each in three documents of one kind: none is left out
    bad = [" ".join(f"bad{chr(97 + i // 3 % 26)}{chr(97 + i // 78)}{chr(97 + j)}x" for j in range(26)) for i in range(300)]
    rows = [(i, t, 1) for i, t in enumerate(bad)] + [(1000 + i, f"good words{chr(97 + i % 26)}", 0) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    vocabulary, w, b = toxicity.train(d.drop("toxic"), d.drop("text"), min_chi=0.0)
    words = {x for t in bad for x in t.split()}
    found = {h - (1 << 64) if h >> 63 else h for h in (xxhash.xxh64_intdigest(x, 42) for x in words)}
    assert len(words) == 2600 and found <= set(vocabulary.tolist()) and len(w) == len(vocabulary)


def test_toxicity_held_out(spark, docs, empty):
    rng = random.Random(9)
    bad = ["vilewort", "hatemuck", "scumlet"]
    rows = [(i, prose(rng, 60) + (" " + " ".join(rng.choices(bad, k=rng.randint(1, 5))) if i % 5 == 0 else "")) for i in range(600)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(400)] + [(5000, 1, 1), (None, 1, 0), (7, None, 0)],
                                "doc_id long, toxic int, quality int")
    model = toxicity.train(d, lab)
    got = {i: (s, p) for i, s, p in rows_of(toxicity.score(d, model))}
    for i in range(400, 600):
        assert (got[i][1] > 0.5) == (i % 5 == 0)
    assert len(model[2]) == 3 and all(s >= p for s, p in got.values())
    assert len(rows_of(toxicity.score(docs, model))) == docs.count() and rows_of(toxicity.score(empty, model)) == []
    none = toxicity.train(d, lab.where("toxic = 0"))
    assert {s for _, s, _ in rows_of(toxicity.score(d, none))} == {0.0}


# -- 4 vectors -------------------------------------------------------------------------------------------

def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + k, (base[k % 10] + rng.normal(scale=s, size=24)).tolist()) for k, s in enumerate(np.linspace(0.02, 0.5, 150))]
    rows += [(400 + k, base[7].tolist()) for k in range(60)] + [(500, (base[7] * 3).tolist()), (0, base[0].tolist())]
    rows += [(600, None), (601, [0.0] * 24), (602, [float("nan")] * 24), (603, [1.0, None]), (604, []), (605, [1.0, 0.0]), (606, [2.0, 0.0])]
    rows += [(0, base[90].tolist()), (0, (-base[91]).tolist())]              # an id that other vectors have too
    d = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rep int, v string")
    got = rows_of(vectors.near_vectors(d))
    ok = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    cos = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    link = [[j for j in range(len(ok)) if j != i and cos(ok[i][1], ok[j][1])] for i in range(len(ok))]
    comp = list(range(len(ok)))
    for _ in ok:
        comp = [min([comp[i], *(comp[j] for j in link[i])]) for i in range(len(ok))]
    low = {c: min(ok[k][0] for k in range(len(ok)) if comp[k] == c) for c in set(comp)}
    want = Counter((i, len(link[k]), low[comp[k]], i == low[comp[k]]) for k, (i, _) in enumerate(ok))
    want.update((i, 0, i, True) for i in (600, 601, 602, 603, 604))
    assert Counter(got) == want
    assert rows_of(vectors.near_vectors(d.limit(0))) == []


def test_vectors_without_ids_and_of_any_size(spark):
    rng = np.random.default_rng(6)
    a, b, c, e = rng.normal(size=(4, 16))
    near = lambda x: x + rng.normal(scale=0.01, size=16)
    rows = [(5, a * 1e200), (3, near(a) * 1e307), (None, near(a) * 1e-300), (None, b), (None, near(b)), (None, b), (9, c * 5e-310),
            (8, near(c)), (None, e), (7, None), (None, None)]
    d = spark.createDataFrame([(i, None if v is None else v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    want = [(5, 2, 3, False), (3, 2, 3, True), (None, 2, 3, False), *[(None, 2, None, True)] * 3, (9, 1, 8, False), (8, 1, 8, True),
            (None, 0, None, True), (7, 0, 7, True), (None, 0, None, True)]
    assert Counter(rows_of(vectors.near_vectors(d))) == Counter(want)
    assert Counter(rows_of(vectors.near_vectors(d.where("vec_id is null")))) == Counter(
        [(None, 0, None, True)] * 3 + [(None, 2, None, True)] * 3)


def test_rotations_keep_length():
    x = np.random.default_rng(1).normal(size=(5, 20))
    for y in vectors.rotations(x, 3, 7):
        assert np.allclose((y * y).sum(axis=1), (x * x).sum(axis=1))


# -- 6 pages ---------------------------------------------------------------------------------------------

def test_main_text_cases():
    f = lambda h: pages.main_text("h", h, {})
    assert f("<body><nav>menu</nav><article><h1>T &amp; U</h1><p><b>a</b>b\n c<br>d<p>e</article><footer>x</footer>") == "T & U ab c d e"
    assert f("<div class='cookie-notice'>we</div><div>one</div><div id=sidebar>side<div>in</div></div>two") == "one two"
    assert f("<script>var t='</p>';</script><p>x &lt; y<form>f</form><div class=comments>c</div>") == "x < y"
    assert f("plain a < b") == "plain a < b" and f("<p") == "" and f("<!-- c --><![CDATA[x]]>") == ""
    assert f("<main><p>m</p><aside>no</aside></main><p>outside") == "m"
    assert f("<header>top</header><article><header><h1>T</h1></header><p>b</p><footer>by</footer></article>") == "T b"


def test_template_words_go(spark):
    rng = random.Random(3)
    own = {i: prose(rng, 30) for i in range(30)}
    rows = [(i, f"http://H.example/{i}", f"<html><body><div>Home About us</div><div><p>{own[i]}</p></div><div>All rights kept</div></body></html>")
            for i in own]
    rows += [(100 + i, "http://hot.example/x", "<body><div>same page text here</div></body>") for i in range(50)]
    rows += [(200, None, None), (201, "nonsense", ""), (202, "http://one.example", "<div>only page</div>")]
    d = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    for limit in (200_000, 0):                       # template broadcast, and joined by host
        got = {i: t for i, _, t in rows_of(pages.extract(d, max_broadcast=limit))}
        assert {i: got[i] for i in own} == own
        assert got[100] == "same page text here" and got[200] == got[201] == "" and got[202] == "only page"
    assert rows_of(pages.extract(d.limit(0))) == []


def test_template_lines_inside_articles_go(spark):
    rng = random.Random(8)
    own = {i: prose(rng, 30) for i in range(20)}
    rows = [(i, f"http://h.example/{i}", f"<html><body><article><h1>{own[i][:9]}</h1><div>Share this with your friends</div>"
             f"<div><p>{own[i]}</p></div><div>Advert: buy one</div></article></body></html>") for i in own]
    rows += [(100 + i, f"http://m.example/{i}", f"<body><main><p>{own[i]}</p><div>Read on in our app</div></main></body>") for i in own]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (200_000, 0):
        got = {i: t for i, _, t in rows_of(pages.extract(d, max_broadcast=limit))}
        assert {i: got[i] for i in own} == {i: " ".join(f"{own[i][:9]} {own[i]}".split()) for i in own}
        assert {i: got[100 + i] for i in own} == own


def test_names_do_not_cut_the_article():
    f = lambda h: pages.main_text("h", h, {})
    assert f("<div class='layout has-sidebar'><article>a b</article></div>") == "a b"
    assert f("<div class='elementor-widget-container'><p>a</p></div><section id='search-results'>b</section><div class=social-studies>c</div>") == "a b c"
    assert f("<article><header class='entry-header'><h1>T</h1></header><p>b</p></article>") == "T b"
    assert f("<div class='widget'><main><p>m</p></main></div><div class=sidebar><article>teaser</article></div>") == "m"
    assert f("<form><div class=search><article>all the text</article></div></form><footer>f</footer>") == "all the text"
    assert f("<div class=sidebar><article>teaser</article></div><article>a b</article>") == "a b"
    assert f("<div>the page is without an article</div><div class=comments><article>me too</article></div>") == "the page is without an article"
    assert f("<aside><article>teaser</article></aside><div class='ad-1'>x</div>one") == "one"


def test_comments_adverts_and_quoted_marks():
    f = lambda h: pages.main_text("h", h, {})
    for name in ("comment-list", "comments-area", "commentlist", "disqus_thread", "ad-slot", "adSlot", "user-comments", "site-header",
                 "post-comments", "related-posts", "cookieBar", "ad_unit_3"):
        for mark in (f"class='x {name}'", f"id={name}", f'role = "{name}"'):
            assert f(f"<div><p>own text</p></div><div {mark}><p>he said</p></div>") == "own text"
            if name != "site-header":
                assert f(f"<article><p>own text</p><div {mark}><p>he said</p></div></article>") == "own text"
    for name in ("post-header", "entry-content", "comments-open", "no-sidebar", "page-content", "adaptive", "threads", "main-body"):
        assert f(f"<div class={name}><p>own</p></div><div>text</div>") == "own text"
    assert f("<div data-id=comments title='class of ads'>own</div>") == "own"
    assert f('<p title="a > b" class="x">Hello <a href=\'?q=">"\'>you</a></p>') == "Hello you"
    assert f("<p title='it is>n't>Hello") == "Hello" and f('<p title="open>Hello') == "Hello"
    assert f('<script data-x="a>b">var x</script><p a = "1>2">Hello') == "Hello"


def test_text_that_stands_in_a_named_element_only():
    f = lambda h: pages.main_text("h", h, {})
    assert f("<nav>menu</nav><div class=legal><h1>T</h1><p>a b</p><form>f</form><div class=ads>x y z</div></div><footer>f</footer>") == "T a b"
    assert f("<body><form><div>a b c</div><input></form><div class=search>s</div></body>") == "a b c"
    assert f("<div class=cookies>we use them</div><nav>menu</nav>") == ""
    assert f("<div class=legal>by me</div><p>text") == "text"


def test_deep_pages_take_linear_memory():
    import tracemalloc
    def peak(n):
        tracemalloc.start()
        steps = pages.steps_of("<div class=a>" * n + "<p>x</b>" * n)
        size = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return size, len(steps)
    (a, n), (b, m) = peak(2000), peak(8000)
    assert m == 4 * n and b < 6 * a


# -- 3 repeats -------------------------------------------------------------------------------------------

def slow_removal(rows, window):
    data = [(i, (t or "").encode()) for i, t in rows]
    n = Counter(b[p:p + window] for _, b in data for p in range(len(b) - window + 1))
    out = Counter()
    for i, b in data:
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - window + 1):
            if n[b[p:p + window]] > 1:
                gone[p] += 1
                gone[p + window] -= 1
        m = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(b, np.uint8)[~m].tobytes()
        out[i, len(b), int(m.sum()), int(m[:1].sum() + (m[1:] & ~m[:-1]).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("shard", [1 << 20, 3000])
def test_repeats_equal_brute_force(spark, docs, empty, monkeypatch, shard):
    rng = random.Random(7)
    common, short = prose(rng, 60), prose(rng, 30)[:199]
    rows = [(i, t) for i, t, *_ in given(docs) if i != 304]
    rows += [(700 + k, prose(rng, 20) + " " + common + " " + prose(rng, 25) + short) for k in range(25)]
    rows += [(800, "ab" * 400), (801, "z" * 1000), (802, common[:200]), (803, "é" * 300 + common + "\x00" * 250)]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int").repartition(4)
    monkeypatch.setattr(repeats, "SHARD", shard)
    got = Counter(rows_of(repeats.remove_repeats(d, with_text=False).drop("kept")))
    assert got == slow_removal(rows, 200)
    assert rows_of(repeats.remove_repeats(empty)) == []


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(5)
    for t in (rng.integers(97, 99, 400), np.full(300, 97), np.tile(rng.integers(97, 110, 40), 12)):
        t = t.astype(np.uint8)
        s = t.tobytes()
        sa, head, h, _ = repeats.suffix_array(t, 64)
        assert sorted(sa.tolist()) == list(range(len(s))) and h >= 64 or len(set(head.tolist())) == len(s)
        cut = [s[i:i + 64] for i in sa]
        assert cut == sorted(cut)
        at = np.sort(sa[1:][head[1:] != head[:-1]])    # pairs in strict order, as the bound asks
        before = np.empty(len(s), np.int64)
        before[sa[1:]] = sa[:-1]
        got = repeats.common_prefixes(t, at, before[at], 0, 32)
        for i, n in zip(at, got):
            a, b = s[i:], s[before[i]:]
            # past the end the padded zeros compare equal
            true = next((k for k in range(32) if a[k:k + 1].ljust(1, b"\0") != b[k:k + 1].ljust(1, b"\0")), 32)
            assert n == true


def test_block_boundaries_inside_a_long_text(monkeypatch):
    rng = random.Random(12)
    part = prose(rng, 90)
    rows = [(1, prose(rng, 700) + part + prose(rng, 600) + part + prose(rng, 500)), (2, prose(rng, 50) + part)]
    monkeypatch.setattr(repeats, "BLOCK", 1500)
    # in this process: worker processes don't see the patched block size
    data = [(i, t.encode()) for i, t in rows]
    body = np.frombuffer(b"".join(b for _, b in data), np.uint8)
    ends = np.cumsum([len(b) for _, b in data])
    starts = [b.starts + b.lo for _, b in repeats.blocks(body, ends, 200, 64)]
    assert np.array_equal(np.concatenate(starts), np.concatenate(
        [np.arange(e - len(b), e - 199) for (_, b), e in zip(data, ends)]))
    anchors = Counter()
    for k, b in repeats.blocks(body, ends, 200, 64):
        for f, la, a in zip(b.first, b.last, b.anchor):
            for p in range(f, la + 1):
                anchors[body[b.lo + p:b.lo + p + 200].tobytes(), int(a)] += 1
    of = defaultdict(set)
    for (s, a), _ in anchors.items():
        of[s].add(a)
    assert all(len(v) == 1 for v in of.values())       # equal windows, equal anchors, whatever the block
