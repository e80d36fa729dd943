"""Whitening, SimHash classes and fill-in-the-middle against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import zstandard
from xxhash import xxh64_intdigest

from ohlcflow.llm import components, fim, queries, simhash, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, fp long, n string, root long, point long"


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, 7, "x", 1, 2) for i, t in zip(ids, texts)], SCHEMA).repartition(4)


# ------------------------------------------------------------------ components
def brute_components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "cycles", "grid"])
def test_components_match_union_find(spark, kind):
    rng = random.Random(3)
    pairs = {"chain": [(i, i + 1) for i in range(300)], "star": [(500, i) for i in range(400)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)],
             "cycles": [(10 * c + i, 10 * c + (i + 1) % 10) for c in range(20) for i in range(10)],
             "grid": [(20 * r + c, 20 * r + c + 1) for r in range(10) for c in range(19)]
             + [(-5, -5), (20, 40), (2 ** 62, -2 ** 62)]}[kind]
    got = components.least_members(spark.createDataFrame(pairs, "a long, b long"))
    want = {k: v for k, v in brute_components(pairs).items() if k != v or k != -5}
    rows = got.collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.least for r in rows} == {k: v for k, v in want.items() if k != -5}


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")) is None
    assert components.least_members(spark.createDataFrame([], "a long, b long")) is None


# -------------------------------------------------------------------- 12 SimHash
def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_simhash(rows):
    fp = [brute_print(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i + 1) if bin(fp[i] ^ fp[j]).count("1") <= 2]
    root = brute_components(pairs)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return sorted(((d, f"{fp[i]:016x}", least.get(root[i])) for i, (d, _) in enumerate(rows)), key=str)


def near_texts(rng, n, families):
    out = []
    for _ in range(families):
        w = [f"w{rng.randrange(3000)}" for _ in range(400)]
        for _ in range(n):
            v = list(w)
            v[rng.randrange(len(v))] = f"w{rng.randrange(3000)}"
            out.append(" ".join(v))
    return out


def test_simhash_matches_brute_force(spark):
    rng = random.Random(11)
    texts = near_texts(rng, 40, 5) + [None, "", " \n\t\x0b", "A b", "a  B", "Ä b c", "ä b c", "x y z", "a\x1cb c d"] * 2
    texts += ["same text of a hot group"] * 60 + ["lang " * 5000, "p q r s"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[3] = ids[4] = None
    ids[10] = ids[11]
    got = simhash.near_duplicates(table(spark, texts, ids))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_simhash(list(zip(ids, texts)))


def test_balls_find_all_near_prints(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for f in base:
        g = f
        for _ in range(6):                        # chains of steps of one, two and three bits
            for b in rng.sample(range(64), rng.choice((1, 2, 2, 3))):
                g ^= 1 << b
            prints.add(g)
    prints |= {0, 1, 3, 7, 2 ** 64 - 1, 2 ** 63}
    prints = sorted(prints)
    signed = [p - 2 ** 64 if p >> 63 else p for p in prints]
    got = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")).collect()
    assert all(bin((r.a ^ r.b) & (2 ** 64 - 1)).count("1") in (1, 2) for r in got)
    want = brute_components([(i, j) for i in range(len(prints)) for j in range(i)
                             if bin(prints[i] ^ prints[j]).count("1") <= 2])
    at = {s: i for i, s in enumerate(signed)}
    assert brute_components([(at[r.a], at[r.b]) for r in got]) == want


def test_simhash_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op12_simhash(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute_simhash([(r.doc_id, r.text) for r in docs.collect()])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(table(spark, ["just one text here"])).count() == 1


# ---------------------------------------------------------- 13 fill in the middle
def brute_fim(doc, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digits = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digits[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form, out = "psm", f"<P>{p}<S>{s}<M>{m}"
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out = "plain", text
    elif h[3] % 100 < 20:
        form, out = "spm", f"<S>{s}<P>{p}<M>{m}"
    plain = form == "plain"
    return (doc, len(u), form, None if plain else len(p), None if plain else len(m),
            hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), out


FIM_TEXTS = [None, "", "a", "<", "<P>", "x<S>y", "naïve café \U0001f600 text!", "letters" * 40, "KKſ ab", "  \n\n ",
             "a<S b<P c<M <<< >>> <S", "one two, three. " * 30, "é" * 50, "M><P", "<M" + "ab" * 20]


@pytest.mark.parametrize("frame", [3, 7, 1 << 16])
def test_fim_matches_brute_force(monkeypatch, frame):
    monkeypatch.setattr(fim, "FRAME", frame)
    pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    rng = random.Random(frame)
    texts = FIM_TEXTS + ["".join(rng.choice("ab <>PSMé\n1") for _ in range(rng.randrange(60))) for _ in range(300)]
    forms = set()
    for doc, text in enumerate(texts):
        text = text or ""
        units, *lists = fim.to_frames(text, pack)
        store = fim.Store(units, len(text), *lists, pack, unpack)
        u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        assert units == len(u)
        want, out = brute_fim(doc, text)
        for k in range(len(u) + 1):
            assert store.char_of(k) == len("".join(u[:k]))
        a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
        assert fim.text_of(store.part(a, b), unpack).decode() == text[a:b]
        if want[2] != "plain":
            for size in (1, 2, 5, 1000):          # the output in frames of any size is read back
                raw = out.encode()
                cut = [pack(raw[i:i + size]) for i in range(0, len(raw), size)]
                assert b"".join(fim.restore(cut, want[2], unpack)).decode() == text
        forms.add(want[2])
    assert forms == {"plain", "psm", "spm"}


def test_only_cut_frames_are_unpacked(monkeypatch):
    monkeypatch.setattr(fim, "FRAME", 10)
    pack, unpack, seen = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress, []
    units, *lists = fim.to_frames("word and " * 200, pack)
    store = fim.Store(units, 1800, *lists, pack, lambda x: seen.append(1) or unpack(x))
    p, q = store.char_of(100), store.char_of(300)
    parts = store.part(0, p), store.part(p, q), store.part(q, 1800)
    assert len(seen) <= 6 and sum(map(len, parts)) >= 180


def test_fim_table(spark, monkeypatch):
    ids = list(range(100, 100 + len(FIM_TEXTS)))
    ids[2] = None
    ids[5] = ids[6]
    df = table(spark, FIM_TEXTS * 3, ids * 3)
    got = fim.digests(fim.fill_in_middle(fim.frame_store(df))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_fim(d, t)[0] for d, t in zip(ids * 3, FIM_TEXTS * 3)), key=str)
    assert fim.digests(fim.fill_in_middle(fim.frame_store(df.limit(0)))).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op13_fill_in_middle(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute_fim(r.doc_id, r.text)[0] for r in docs)


# ----------------------------------------------------------------- 11 whitening
def spectrum(values, seed=0):
    r = np.random.RandomState(seed)
    q, _ = np.linalg.qr(r.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1, 21.0), [5.0] * 12, [9, 9, 9, 4, 4, 4, 4, 4, 4, 4, 1, 1], 10.0 ** np.arange(12), 1 + 1e-9 * np.arange(16),
    [3.0, 2.0, 1.0] + [0.0] * 9, [7.0], np.r_[1e8, 2e8, np.linspace(1, 2, 30)], np.linspace(1, 1.001, 40)])
def test_leading_pairs(values):
    a = spectrum(values, 3)
    a = (a + a.T) / 2
    value, vector = whitening.leading(a, 8)
    want = np.sort(np.array(values, float))[::-1][:8]
    want = want[want > want.max() * len(a) * whitening.EPS * 4]
    assert len(value) == len(want) and np.allclose(value, want, rtol=1e-9, atol=1e-13 * want[0])
    assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-12
    assert np.linalg.norm(a @ vector - vector * value, axis=0).max() <= 1e-11 * want[0]


def test_inertia_counts():
    r = np.random.RandomState(5)
    for d in (1, 2, 5, 17):
        a = r.standard_normal((d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for s in r.uniform(e[0] - 1, e[-1] + 1, 20):
            assert whitening.inertia(a, s) == int((e > s).sum())
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def brute_whiten(rows, k=8):
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    d = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    good = [(i, [int(np.floor(1024 * float(c))) + 100000 for c in v]) for i, v in good if len(v) == d]
    n, s = len(good), [sum(c) for c in zip(*(v for _, v in good))]
    x = np.array([[(n * c - t) / n for c, t in zip(v, s)] for _, v in good])
    cov = x.T @ x / n
    e, u = np.linalg.eigh(cov)
    keep = [j for j in range(d - 1, -1, -1) if e[j] > e[-1] * d * whitening.EPS * 4][:k]
    return n, [(i, sum((n * c - t) ** 2 for c, t in zip(v, s))) for i, v in good], e[keep], np.trace(cov), x @ u[:, keep] / np.sqrt(e[keep])


def check_whitened(got, rows):
    n, dev, e, trace, w = brute_whiten(rows)
    k = len(e)
    assert len(got) == n * k and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, k + 1))
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((str(i), v) for i, v in dev)
    assert all(r.deviation_exact == r.deviation for r in got)
    assert all(abs(r.explained - e[r.component - 1] / trace) < 1e-9 for r in got)
    assert max(r.identity_error for r in got) < 1e-8 and len({r.identity_error for r in got}) == 1
    for c in range(1, k + 1):
        mine = {(r.vec_id, r.deviation): r.whitened for r in got if r.component == c}
        own = {(i, v): y for (i, v), y in zip(dev, w[:, c - 1])}
        sign = 1 if sum(mine[key] * y for key, y in own.items()) > 0 else -1
        assert all(abs(mine[key] * sign - y) < 1e-6 for key, y in own.items())


VEC = "vec_id long, embedding array<double>, n string, component string"


def test_whitening_matches_brute_force(spark):
    r = np.random.RandomState(1)
    rows = [(i, (r.standard_normal(12) * np.arange(1, 13) / 10 + 3).tolist()) for i in range(150)]
    rows += [(200, None), (201, [0.1, None] * 6), (202, [float("nan")] * 12), (203, []), (204, [1.0, 2.0]),
             (205, [float("inf")] * 12), (None, rows[3][1]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VEC).repartition(5)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
    check_whitened(out.collect(), rows)


def test_whitening_odd_tables(spark):
    def rows(vectors):
        return spark.createDataFrame([(i, v, "x", "y") for i, v in enumerate(vectors)], VEC)

    assert whitening.whiten(rows([[1.0, 2.0]]).limit(0)).count() == 0
    assert whitening.whiten(rows([None, [None], []])).count() == 0
    assert whitening.whiten(rows([[1.0, 2.0]] * 5)).count() == 0                      # no variance
    low = [[float(i), 2.0 * i, 1.0] for i in range(6)]                               # rank one
    got = whitening.whiten(rows(low)).collect()
    check_whitened(got, list(enumerate(low)))
    assert len(got) == 6
    far = [[1e6 * i, -5e5 * i * i] for i in range(40)]                               # beyond 32 bits
    assert {r.component for r in whitening.whiten(rows(far)).collect()} == {1, 2}
    wide = [[1.5e5 * i, 1.0 * (i % 3)] for i in range(30)]                             # deviations of 20 digits
    got = {r.vec_id: r for r in whitening.whiten(rows(wide)).collect()}
    x = [[int(1024 * c) + 100000 for c in v] for v in wide]
    s = [sum(c) for c in zip(*x)]
    for i, v in enumerate(x):
        want = sum((30 * c - t) ** 2 for c, t in zip(v, s))
        assert int(got[i].deviation_exact) == want and got[i].deviation == (want if want < 2 ** 63 else None)
    assert any(r.deviation is None for r in got.values()) and any(r.deviation is not None for r in got.values())
    ends = whitening.whiten(rows([[1e300, 1.0], [-1e300, 0.0], [0.0, 0.0]])).collect()
    assert ends and ends[0].deviation is None


def test_whitening_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(queries.op11_whitening(spark, SF).collect(), rows)
