"""Exact top-k against brute force."""

import numpy as np
from pyspark.sql import functions as F

from ohlcflow.llm import topk


def brute(rows, k, mod):
    v = {}
    for i, x in rows:
        if i is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        q = [int(np.floor(256.0 * c)) for c in x]
        v[i] = min(v.get(i, q), q)
    out = []
    for i in v:
        if i % mod == 0:
            s = sorted((-sum(a * b for a, b in zip(v[i], v[j])), j) for j in v if j != i and len(v[j]) == len(v[i]))
            out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s[:k])]
    return sorted(out)


def test_topk_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "STEP", 5)
    r = np.random.RandomState(1)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0, 0.2, 12)]) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(30)]                       # many equal vectors
    rows += [(300, None), (301, [0.1, None]), (305, [float("nan")] * 12), (None, rows[0][1]), (310, [1.0, 2.0]),
             (311, [3.0, 1.0]), (320, []), (10, rows[10][1]), (315, [float("inf")] * 12), (330, [-1e6] * 12), (331, [1e6] * 12)]
    df = spark.createDataFrame([(i, x, "n") for i, x in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(x) for x in topk.top_k(df.repartition(6), F.col("vec_id") % 5 == 0).collect())
    assert got == brute(rows, 5, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_bound_order_stops_early():
    r = np.random.RandomState(2)
    x = np.concatenate([r.randint(90, 100, (50, 4)), r.randint(-100, -90, (4000, 4))]).astype(np.int64)
    pivots = {4: x[[0, 60]].astype(float)}
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, i):
            out = super().__getitem__(i)
            if isinstance(i, np.ndarray):
                seen.append(len(i))
            return out

    q, ids = x[:1], np.arange(len(x))
    xd = topk._distances(x, pivots)
    (s, best), = topk.block_top(ids[:1], q, xd[:1], ids, x.view(Counted), xd, 5)
    want = sorted(range(1, len(x)), key=lambda j: (-int(x[j] @ q[0]), j))[:5]
    assert best.tolist() == want and sum(seen) < len(x) / 4
