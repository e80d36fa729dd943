"""LSTM kernels and folds against the worked example (FIXTURES G2)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohlcflow.operators import lstm as L
from ohlcflow.operators import lstm_train as LT

X2 = np.array([[[1.0, 2.0], [0.5, 3.0]]])      # one window, two steps, two inputs
Y2 = np.array([[0.5, 1.25]])
THETA = L.theta_from_gates(L.FIXED_TEST_WEIGHTS)

# (a, i, f, o, c, h) per step
G2_STEPS = [
    (0.81775408, 0.96083428, 0.85195280, 0.81757448, 0.78572615, 0.53631340),
    (0.84980402, 0.98118397, 0.87030197, 0.84993334, 1.51763310, 0.77198111),
]
# gate -> (dw1, dw2, du, db)
G2_GRADS = {
    "a": (-0.02671622, -0.09220113, -0.01039609, -0.03640839),
    "i": (-0.00220369, -0.00663861, -0.00059832, -0.00276150),
    "f": (-0.00315327, -0.01891963, -0.00338228, -0.00630654),
    "o": (-0.02592411, -0.16260389, -0.02969987, -0.05361303),
}


def test_forward_steps_match_worked_example():
    _, cache = L.forward(THETA, X2, keep=True)
    for t, exp in enumerate(G2_STEPS):
        a, i, f, o, c, h = (cache[t][k][0] for k in range(6))
        assert np.allclose([a, i, f, o, c, h], exp, atol=1e-8)


def test_backward_matches_worked_example():
    g, loss, steps = L.backward(THETA, X2, Y2)
    got = L.gates_from_theta(g, 2)
    for gate, exp in G2_GRADS.items():
        w, u, b = got[gate]
        assert np.allclose([*w, u, b], exp, atol=1e-8), gate
    assert steps == 2
    assert loss == pytest.approx(0.00065933 + 0.11425103, abs=1e-8)


def test_one_sgd_step():
    g, _, _ = L.backward(THETA, X2, Y2)
    a = L.gates_from_theta(L.sgd_step(THETA, g, 0.1), 2)["a"]
    assert np.allclose([*a[0], a[1], a[2]], [0.45267162, 0.25922011, 0.15103961, 0.20364084], atol=1e-8)


def test_gradient_matches_central_differences():
    rng = np.random.default_rng(7)
    X = rng.random((4, 5, 3))
    Y = rng.random((4, 5))
    Y[1, 2] = np.nan                                  # a step without target
    th = rng.random(4 * 5)
    g, _, _ = L.backward(th, X, Y)

    def loss(t):
        return L.backward(t, X, Y)[1]
    num = np.zeros_like(th)
    for k in range(th.size):
        e = np.zeros_like(th)
        e[k] = 1e-6
        num[k] = (loss(th + e) - loss(th - e)) / 2e-6
    assert np.allclose(g, num, atol=1e-6)


def test_windows_of_counts():
    v = np.arange(20.0)[:, None]
    X, Y = L.windows_of(v, np.arange(20.0), 4)
    assert X.shape == (16, 4, 1) and Y.shape == (16, 4)
    assert L.windows_of(v, np.arange(20.0), 4, include_last=True)[0].shape[0] == 17
    assert L.windows_of(v[:3], np.arange(3.0), 4)[0].shape[0] == 0


def test_fold_equals_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.random((30, 6, 2))
    rows = [(i, X[i].tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, xs array<array<double>>")
    lit = df.select("id", L.lstm_fold(F.col("xs"), L.FIXED_TEST_WEIGHTS, 2).alias("h")).orderBy("id").collect()
    col = (df.withColumn("theta", F.array(*[F.lit(float(v)) for v in THETA]))
           .select("id", L.lstm_fold(F.col("xs"), F.col("theta"), 2).alias("h")).orderBy("id").collect())
    ref = L.forward(THETA, X)
    assert np.allclose([r.h for r in lit], ref, atol=1e-12)
    assert np.allclose([r.h for r in col], ref, atol=1e-12)


def test_fold_worked_example(spark):
    df = spark.createDataFrame([(X2[0].tolist(),)], "xs array<array<double>>")
    h = df.select(L.lstm_fold("xs", L.FIXED_TEST_WEIGHTS, 2).alias("h")).first().h
    assert h == pytest.approx(0.771981105758891, abs=1e-12)


def test_params_roundtrip(spark, tmp_path):
    thetas = {"AAA": L.init_theta(2, 1), "BBB": L.init_theta(2, 2)}
    p = L.params_frame(spark, thetas, 2, version=3)
    path = str(tmp_path / "params")
    L.save_params(p, path)
    back = {r.symbol: np.array(r.theta) for r in L.theta_column(L.load_params(spark, path)).collect()}
    for k, v in thetas.items():
        assert np.allclose(back[k], v)


def _series(spark, sizes, seed, n_features=2):
    """Frame (symbol, ts, x0.., y) and the same series as arrays."""
    rng = np.random.default_rng(seed)
    rows, series = [], {}
    for s, n in sizes.items():
        v, y = rng.random((n, n_features)), rng.random(n)
        series[s] = (v, y)
        rows += [(s, dt.datetime(2024, 1, 1) + dt.timedelta(hours=t), *v[t].tolist(), float(y[t])) for t in range(n)]
    xs = ", ".join(f"x{k} double" for k in range(n_features))
    return spark.createDataFrame(rows, f"symbol string, ts timestamp_ntz, {xs}, y double").repartition(3), series


def _descend(theta, v, y, b, epochs, lr):
    X, Y = L.windows_of(v, y, b)
    loss = None
    for _ in range(epochs):
        g, l, steps = L.backward(theta, X, Y)
        theta, loss = theta - lr * g / steps, l / steps
    return theta, loss, len(X)


@pytest.mark.parametrize("chunk", [5, 7, 4096])
def test_chunk_gradients_equal_all_windows(spark, chunk):
    df, series = _series(spark, {"A": 40, "B": 6, "C": 5}, 5)
    packed = LT.pack_series(df, ["x0", "x1"], "y", 5, chunk_rows=chunk)
    got = LT.sum_gradients(LT.gradient_rows(packed, 2, theta=THETA, b=5), THETA.size)
    exp = [L.backward(THETA, *L.windows_of(v, y, 5)) for v, y in series.values()]
    assert np.allclose(got[0], sum(e[0] for e in exp), atol=1e-12)
    assert got[1] == pytest.approx(sum(e[1] for e in exp)) and got[2] == sum(e[2] for e in exp) == (35 + 1) * 5


def test_packed_rows_are_bars_and_halos(spark):
    df, _ = _series(spark, {"A": 40}, 6)
    sizes = [len(r.ys) for r in LT.pack_series(df, ["x0", "x1"], "y", 5, chunk_rows=10).orderBy("first").collect()]
    assert sizes == [14, 14, 14, 10]


def test_gradient_skips_null_inputs_and_targets():
    rng = np.random.default_rng(2)
    v, y = rng.random((12, 2)), rng.random(12)
    v[6, 1], y[1] = np.nan, np.nan
    got = LT.chunk_gradient(THETA, v, y, 3, 9)
    X, Y = L.windows_of(v, y, 3)
    keep = [0, 1, 2, 3, 7, 8]
    exp = L.backward(THETA, X[keep], Y[keep])
    assert np.allclose(got[0], exp[0]) and got[2] == exp[2] and got[3] == 6
    last = LT.chunk_gradient(THETA, v, y, 3, 9, last_only=True)
    assert last[2] == 6


def test_slabs_do_not_change_the_gradient(monkeypatch):
    rng = np.random.default_rng(2)
    v, y = rng.random((50, 2)), rng.random(50)
    whole = LT.chunk_gradient(THETA, v, y, 4, 46)
    monkeypatch.setattr(LT, "SLAB_STEPS", 12)
    parts = LT.chunk_gradient(THETA, v, y, 4, 46)
    assert np.allclose(whole[0], parts[0]) and whole[2:] == parts[2:]


def test_train_per_symbol_equals_numpy(spark):
    """One hot symbol over many chunks, one short, one without a window; with
    and without stored parameters; several grid points in one pass."""
    df, series = _series(spark, {"A": 60, "B": 12, "C": 3}, 3)
    fresh = {r.symbol: np.array(r.t) for r in df.select("symbol", LT.init_theta_column("symbol", 2, 9).alias("t"))
             .distinct().collect()}
    grid = [dict(b=5, epochs=2, lr=0.3), dict(b=3, epochs=1, lr=0.1)]
    init = spark.createDataFrame([("A", THETA.tolist())], "symbol string, theta array<double>")
    for start in (None, init):
        got = {(r.symbol, r.grid_id): r for r in LT.train_per_symbol(
            df, ["x0", "x1"], "y", 5, seed=9, grid=grid, init=start, chunk_rows=10).collect()}
        assert len(got) == 6
        for s, (v, y) in series.items():
            for i, p in enumerate(grid):
                th0 = THETA if start is not None and s == "A" else fresh[s]
                r = got[s, i]
                if len(v) <= p["b"]:
                    assert r.loss is None and r.windows == 0 and np.allclose(r.theta, th0)
                    continue
                th, loss, n = _descend(th0, v, y, **p)
                assert np.allclose(r.theta, th, atol=1e-12) and r.windows == n and r.loss == pytest.approx(loss)


def _in_order(theta, v, y, b, epochs, lr):
    """A window after the other, each by the vectorised kernel."""
    X, Y = L.windows_of(v, y, b)
    loss = None
    for _ in range(epochs):
        total, steps, n = 0.0, 0, 0
        for x, t in zip(X, Y):
            if np.isnan(x).any():
                continue
            g, l, s = L.backward(theta, x[None], t[None])
            theta, total, steps, n = theta - lr * g, total + l, steps + s, n + 1
        loss = total / steps if steps else None
    return theta, loss, n


@pytest.mark.parametrize("chunk", [9, 16, 4096])
def test_training_in_order_equals_a_loop(spark, chunk):
    """Relay over several waves, symbols of different lengths, stored and fresh
    parameters, grid points with their own windows and epochs."""
    df, series = _series(spark, {"A": 60, "B": 12, "C": 3}, 3)
    fresh = {r.symbol: np.array(r.t) for r in df.select("symbol", LT.init_theta_column("symbol", 2, 9).alias("t"))
             .distinct().collect()}
    grid = [dict(b=5, epochs=2, lr=0.3), dict(b=3, epochs=1, lr=0.1), dict(b=8, epochs=3, lr=1.0)]
    init = spark.createDataFrame([("A", THETA.tolist())], "symbol string, theta array<double>")
    for start in (None, init):
        got = {(r.symbol, r.grid_id): r for r in LT.train_in_order(
            df, ["x0", "x1"], "y", 5, seed=9, grid=grid, init=start, chunk_rows=chunk).collect()}
        assert len(got) == 9
        for s, (v, y) in series.items():
            for i, p in enumerate(grid):
                th0 = THETA if start is not None and s == "A" else fresh[s]
                r = got[s, i]
                if len(v) <= p["b"]:
                    assert r.loss is None and r.windows == 0 and np.allclose(r.theta, th0)
                    continue
                th, loss, n = _in_order(th0, v, y, **p)
                assert np.allclose(r.theta, th, atol=1e-10) and r.windows == n and r.loss == pytest.approx(loss)


def test_update_in_order_on_the_golden_series():
    """Window 72 over the recorded bars, and gaps in inputs and targets."""
    import pandas as pd
    from conftest import fixture_path
    bars = pd.read_csv(fixture_path("bars_5min.csv"))
    v = bars[["Open", "High", "Low", "Close", "Volume", "Trade_count", "vwap"]].to_numpy(float)
    v = (v - v.min(0)) / (v.max(0) - v.min(0))
    y = np.append(v[1:, 3], v[1:, 3].mean())
    th0 = L.init_theta(7, 3)
    got = LT.update_in_order(th0, v, y, 72, len(v) - 72, 0.5)
    th, loss, n = _in_order(th0, v, y, 72, 1, 0.5)
    assert got[3] == n == 216 and np.allclose(got[0], th, atol=1e-9) and got[1] / got[2] == pytest.approx(loss)
    v[40, 2], y[100:120] = np.nan, np.nan
    got = LT.update_in_order(th0, v, y, 24, len(v) - 24, 0.5)
    th, loss, n = _in_order(th0, v, y, 24, 1, 0.5)
    assert got[3] == n and np.allclose(got[0], th, atol=1e-9) and got[1] / got[2] == pytest.approx(loss)


def test_one_update_matches_worked_example():
    th, loss, steps, windows = LT.update_in_order(THETA, X2[0], Y2[0], 2, 1, 0.1)
    g, l, s = L.backward(THETA, X2, Y2)
    assert np.allclose(th, L.sgd_step(THETA, g, 0.1), atol=1e-12) and loss == pytest.approx(l) and (steps, windows) == (s, 1)


def test_training_of_empty_rows(spark):
    df, _ = _series(spark, {"A": 4}, 1)
    none = df.where("false")
    assert LT.train_in_order(none, ["x0", "x1"], "y", 3).count() == 0
    assert LT.train_per_symbol(none, ["x0", "x1"], "y", 3).count() == 0
    th, hist = LT.train_distributed(LT.pack_series(none, ["x0", "x1"], "y", 3), 2, 3, epochs=1, theta=THETA)
    assert np.allclose(th, THETA) and hist == [0.0]


def test_pooled_training_lowers_loss(spark):
    df, series = _series(spark, {"A": 30, "B": 20}, 8)
    th0 = L.init_theta(2, 1)
    th, hist = LT.train_distributed(LT.pack_series(df, ["x0", "x1"], "y", 4, chunk_rows=8), 2, 4, epochs=3, lr=0.2,
                                    theta=th0)
    X, Y = (np.concatenate(p) for p in zip(*[L.windows_of(v, y, 4) for v, y in series.values()]))
    exp = th0
    for k in range(3):
        g, loss, steps = L.backward(exp, X, Y)
        assert hist[k] == pytest.approx(loss / steps)
        exp = exp - 0.2 * g / steps
    assert np.allclose(th, exp, atol=1e-12) and hist[2] < hist[0]
