"""A one-unit LSTM over bar windows: parameters, scoring, kernels (M0-M4, K5).

Cell (per step t, state reset to zero at every window start):

    z_g = w_g . x_t + u_g * h_{t-1} + b_g        for gates g in a, i, f, o
    a = tanh(z_a); i, f, o = sigmoid(z_i), sigmoid(z_f), sigmoid(z_o)
    c_t = a * i + f * c_{t-1};  h_t = tanh(c_t) * o

Scoring of short windows (M1) is a Catalyst ``aggregate`` fold, so it runs
inside whole-stage code generation with no Python worker. Long windows (M2)
and gradients (M3) use numpy inside Arrow-batched workers, vectorised across
windows (windows are independent because the state resets). Training over
whole tables is in ``lstm_train``.

Parameters travel as a flat vector ``theta`` of length 4 * (F + 2), gate-major
(for each gate: F input weights, recurrent weight u, bias b), or as the long
table ``PARAMS`` (symbol, version, gate, w, u, b) for storage.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import SIGMOID_EPS, dot, minmax_inverse, sigmoid
from ..schema import GATES, PARAMS
from .series import DEFAULT_CHUNK_ROWS, chunked, ensure_index

# The worked-example weights (two inputs) of the reference's
# test mode, gate -> (input weights, recurrent weight, bias).
FIXED_TEST_WEIGHTS = {
    "a": ([0.45, 0.25], 0.15, 0.2),
    "i": ([0.95, 0.8], 0.8, 0.65),
    "f": ([0.7, 0.45], 0.1, 0.15),
    "o": ([0.6, 0.4], 0.25, 0.1),
}


# ---------------------------------------------------------------- parameters

def theta_from_gates(gates: dict) -> np.ndarray:
    """gate -> (w, u, b) to the flat vector."""
    parts = []
    for g in GATES:
        w, u, b = gates[g]
        parts += [*map(float, w), float(u), float(b)]
    return np.asarray(parts, dtype=np.float64)


def gates_from_theta(theta, n_features: int) -> dict:
    theta = np.asarray(theta, dtype=np.float64)
    k = n_features + 2
    out = {}
    for j, g in enumerate(GATES):
        seg = theta[j * k:(j + 1) * k]
        out[g] = (seg[:n_features].tolist(), float(seg[n_features]), float(seg[n_features + 1]))
    return out


def init_theta(n_features: int, seed: int = 0) -> np.ndarray:
    """M0: uniform [0, 1) weights, seeded (the reference leaves them unseeded)."""
    return np.random.default_rng(seed).random(4 * (n_features + 2))


def params_frame(spark: SparkSession, thetas: dict, n_features: int, version: int = 0) -> DataFrame:
    """Long PARAMS table from {symbol: theta}."""
    rows = []
    for sym, th in thetas.items():
        for g, (w, u, b) in gates_from_theta(th, n_features).items():
            rows.append((sym, int(version), g, [float(x) for x in w], float(u), float(b)))
    return spark.createDataFrame(rows, PARAMS)


def theta_column(params: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """PARAMS (long, possibly several versions) -> (keys, version, theta) with
    the newest version per key."""
    keys = list(keys)
    newest = params.groupBy(*keys).agg(F.max("version").alias("version"))
    p = params.join(newest, [*keys, "version"])
    flat = F.concat(F.col("w"), F.array(F.col("u"), F.col("b")))
    order = F.array_position(F.array(*[F.lit(g) for g in GATES]), F.col("gate"))
    return (p.groupBy(*keys, "version")
            .agg(F.array_sort(F.collect_list(F.struct(order.alias("k"), flat.alias("v")))).alias("_g"))
            .withColumn("_g", F.when(F.size("_g") == len(GATES), F.col("_g")).otherwise(
                F.raise_error(F.lit("a key and version must have one row per gate"))))
            .select(*keys, "version", F.flatten(F.transform("_g", lambda s: s["v"])).alias("theta")))


# ---------------------------------------------------------------- M1 fold

def _gate_terms(params, n_features: int):
    """Per gate (w list of Columns/floats, u, b) from a dict of literals or a
    theta Column."""
    if isinstance(params, Column):
        k = n_features + 2
        return {g: ([params[j * k + m] for m in range(n_features)], params[j * k + n_features],
                    params[j * k + n_features + 1]) for j, g in enumerate(GATES)}
    return {g: (list(params[g][0]), F.lit(float(params[g][1])), F.lit(float(params[g][2]))) for g in GATES}


def lstm_fold(xs, params, n_features: int) -> Column:
    """M1: final output h of each window ``xs`` (array<array<double>>).

    ``params`` is either a dict gate -> (w, u, b) of numbers (folded to
    literals) or a theta Column joined per key (J2).
    """
    terms = _gate_terms(params, n_features)
    xs = xs if isinstance(xs, Column) else F.col(xs)

    def step(s, x):
        h, c = s["h"], s["c"]
        z = {g: dot([x[m] for m in range(n_features)], w) + u * h + b for g, (w, u, b) in terms.items()}
        c2 = F.tanh(z["a"]) * sigmoid(z["i"]) + sigmoid(z["f"]) * c
        return F.struct((F.tanh(c2) * sigmoid(z["o"])).alias("h"), c2.alias("c"))

    zero = F.struct(F.lit(0.0).alias("h"), F.lit(0.0).alias("c"))
    return F.aggregate(xs, zero, step, lambda s: s["h"])


# ---------------------------------------------------------------- numpy kernels

def _sig(z):
    return 1.0 / (1.0 + np.exp(-(z + SIGMOID_EPS)))


def _split(theta, n_features):
    k = n_features + 2
    th = np.asarray(theta, dtype=np.float64).reshape(4, k)
    return th[:, :n_features], th[:, n_features], th[:, n_features + 1]   # W (4,F), U (4,), B (4,)


def forward(theta, X: np.ndarray, keep: bool = False):
    """Run windows ``X`` (W, b, F) from the zero state; vectorised over W.

    Returns final h (W,), and with ``keep`` the per-step caches for BPTT.
    """
    Wn, b, Fn = X.shape
    W, U, B = _split(theta, Fn)
    h = np.zeros(Wn)
    c = np.zeros(Wn)
    cache = []
    for t in range(b):
        z = X[:, t, :] @ W.T + h[:, None] * U[None, :] + B[None, :]    # (W, 4)
        a = np.tanh(z[:, 0])
        i, f, o = _sig(z[:, 1]), _sig(z[:, 2]), _sig(z[:, 3])
        c_prev, h_prev = c, h
        c = a * i + f * c
        h = np.tanh(c) * o
        if keep:
            cache.append((a, i, f, o, c, h, c_prev, h_prev))
    return (h, cache) if keep else h


def backward(theta, X: np.ndarray, Y: np.ndarray):
    """M3: gradient of sum_t (y_t - h_t)^2 / 2 over every window, summed.

    Backpropagation through time per window (state reset at window start):
    the error of each step plus the error carried back through the recurrent
    weight and the cell. A NaN target marks a step without loss (sequence-to-
    one training uses only the last step). Returns (grad theta, summed loss,
    number of scored steps).
    """
    Wn, b, Fn = X.shape
    W, U, B = _split(theta, Fn)
    _, cache = forward(theta, X, keep=True)
    gW = np.zeros_like(W)
    gU = np.zeros_like(U)
    gB = np.zeros_like(B)
    d_h_next = np.zeros(Wn)
    d_c_next = np.zeros(Wn)
    f_next = np.zeros(Wn)
    loss = 0.0
    counted = 0
    for t in reversed(range(b)):
        a, i, f, o, c, h, c_prev, h_prev = cache[t]
        y = Y[:, t]
        known = ~np.isnan(y)                       # NaN target: no loss at this step
        err = np.where(known, h - np.where(known, y, 0.0), 0.0)
        loss += float(np.sum(err * err) / 2.0)
        counted += int(known.sum())
        d_out = err + d_h_next
        tc = np.tanh(c)
        d_c = d_out * o * (1.0 - tc * tc) + d_c_next * f_next
        d = np.stack([d_c * i * (1.0 - a * a),
                      d_c * a * i * (1.0 - i),
                      d_c * c_prev * f * (1.0 - f),
                      d_out * tc * o * (1.0 - o)], axis=1)             # (W, 4)
        gW += d.T @ X[:, t, :]
        gU += d.T @ h_prev
        gB += d.sum(axis=0)
        d_h_next = d @ U
        d_c_next = d_c
        f_next = f
    grad = np.concatenate([gW, gU[:, None], gB[:, None]], axis=1).reshape(-1)
    return grad, loss, counted


def sgd_step(theta, grad, lr: float):
    """M4: p - lr * g."""
    return np.asarray(theta, dtype=np.float64) - lr * np.asarray(grad, dtype=np.float64)


def windows_of(values: np.ndarray, targets: np.ndarray, b: int, include_last: bool = False):
    """Stride-1 windows of b rows as views: X (n-b, b, F), Y (n-b, b)."""
    n = values.shape[0]
    m = n - b + (1 if include_last else 0)
    if m <= 0:
        return values[:0].reshape(0, b, values.shape[1]), targets[:0].reshape(0, b)
    X = np.lib.stride_tricks.sliding_window_view(values, b, axis=0)[:m].transpose(0, 2, 1)
    Y = np.lib.stride_tricks.sliding_window_view(targets, b)[:m]
    return X, Y


# ---------------------------------------------------------------- M2 bulk

def score_bulk(df: DataFrame, cols: Sequence[str], b: int, theta, keys: Sequence[str] = ("symbol",),
               exclude_current: bool = True, bucket: str = "day",
               chunk_rows: int = DEFAULT_CHUNK_ROWS, keep: Sequence[str] = ()) -> DataFrame:
    """M2: as M1 for long windows, numpy inside ``applyInPandas``.

    Groups are (key, chunk) of ``chunk_rows`` rows plus a ``b``-row halo, so a
    hot symbol spreads over many tasks. ``theta`` is a fixed vector or the
    name of a theta column joined per key (J2). Output: (keys, ts, keep, h) for
    every row with a full window of the previous b rows (``exclude_current``)
    or of the b rows ending at the row.
    """
    keys = list(keys)
    Fn = len(cols)
    idx = ensure_index(df, keys, bucket)
    back = b if exclude_current else b - 1
    frame, _ = chunked(idx, keys, back=back, chunk_rows=max(chunk_rows, b + 1))
    theta_col = theta if isinstance(theta, str) else None
    fixed = None if theta_col else np.asarray(theta, dtype=np.float64)
    kept = [*keys, "ts", *keep]
    sel = [*kept, "_g", "_own", "_chunk", *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(cols)]]
    if theta_col:
        sel.append(theta_col)
    frame = frame.select(*sel)
    out_schema = T.StructType([*[frame.schema[c] for c in kept], T.StructField("h", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_g", kind="stable")
        th = fixed if theta_col is None else np.asarray(pdf[theta_col].iloc[0], dtype=np.float64)
        vals = pdf[[f"_x{j}" for j in range(Fn)]].to_numpy(np.float64)
        n = len(pdf)
        if n < b + (1 if exclude_current else 0):
            empty = pdf.iloc[0:0][kept].copy()
            empty["h"] = np.array([], dtype=np.float64)
            return empty
        win = np.lib.stride_tricks.sliding_window_view(vals, b, axis=0).transpose(0, 2, 1)   # (n-b+1, b, F)
        h = forward(th, win)
        if exclude_current:
            rows = pdf.iloc[b:]               # window k (rows k..k+b-1) scores row k+b
            h = h[:n - b]
        else:
            rows = pdf.iloc[b - 1:]
        own = (rows["_own"].to_numpy() == rows["_chunk"].to_numpy()) & (rows["_g"].to_numpy() >= back)
        res = rows.loc[own, kept].copy()
        res["h"] = h[own]
        return res

    return frame.groupBy(*keys, "_chunk").applyInPandas(run, out_schema)


# ---------------------------------------------------------------- K5

def thetas_to_params(trained: DataFrame, n_features: int, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """K5 layout: (keys, version, theta) -> long PARAMS rows."""
    keys = list(keys)
    k = n_features + 2
    gate_rows = F.array(*[F.struct(F.lit(g).alias("gate"),
                                   F.slice("theta", j * k + 1, n_features).alias("w"),
                                   F.col("theta")[j * k + n_features].alias("u"),
                                   F.col("theta")[j * k + n_features + 1].alias("b"))
                          for j, g in enumerate(GATES)])
    return (trained.select(*keys, "version", F.explode(gate_rows).alias("_p"))
            .select(*keys, "version", "_p.gate", "_p.w", "_p.u", "_p.b"))


def save_params(params: DataFrame, path: str) -> None:
    """K5: store parameter versions (Parquet, partitioned by version). Saving a
    version again, as a replayed batch does, replaces its folder alone."""
    (params.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version").parquet(path))


def load_params(spark: SparkSession, path: str) -> DataFrame:
    """K5: all stored versions; ``theta_column`` picks the newest per key."""
    return spark.read.parquet(path)
