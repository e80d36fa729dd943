"""LSTM training as Spark jobs.

Windows overlap in all but one row, so they are never written out. A series is
stored once as packed chunks (``pack_series``): one row per (key, chunk) with
``chunk_rows`` consecutive bars and the halo its last windows reach into.
Workers view the windows of a chunk as strides of its arrays.

An epoch is full-batch gradient descent: every chunk gives one gradient row
per parameter set (M3, ``mapInPandas``), the rows are summed per key (A8, a
partial aggregate) and the parameters, a column of a small table, move against
the mean gradient (M4). A hot symbol is many chunks, hence many tasks; all
rows of a series take part and the driver holds no parameters of a key.

Training with an update after every window, in order (``train_in_order``, M5),
is a relay over the same chunks: in wave k the k-th chunk of every key and grid
point moves its parameters window by window and hands them on through a small
stored table. Keys and grid points run side by side, a series held by one chunk
runs all its epochs in one wave, and a lost executor repeats one wave at most.

Windows with a null or NaN input take no part; a null target marks a step
without loss. A key without any scored step keeps its parameters and has a
null loss.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import SIGMOID_EPS
from ..schema import GATES
from ..session import scratch_path
from .lstm import backward, init_theta, sgd_step, windows_of
from .series import chunked, ensure_index

# Bars per packed chunk: 7 features of 4,096 bars are 230 kB, a small record
# beside which the halo (a window length) does not count.
CHUNK_ROWS = 1 << 12

# Steps (windows x window length) that one call of the kernel caches at once.
SLAB_STEPS = 1 << 18


def init_theta_column(key: str, n_features: int, seed: int = 0) -> Column:
    """M0 per key: uniform [0, 1) from the first 32 bits of
    md5(key:seed:position), the same on every executor and retry."""
    def unit(k):
        h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(k))))
        return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.array(*[unit(k) for k in range(len(GATES) * (n_features + 2))])


def pack_series(df: DataFrame, cols: Sequence[str], target: str, b: int, keys: Sequence[str] = ("symbol",),
                bucket: str = "day", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(keys, first, n, size, xs, ys): rows ``first`` .. of a key of ``n`` rows,
    ``xs`` row-major inputs, ``ys`` targets, both with the halo for windows of
    up to ``b`` rows; ``size`` rows are the chunk's own window starts."""
    keys = list(keys)
    size = max(chunk_rows, b)
    frame, _ = chunked(ensure_index(df, keys, bucket), keys, fwd=b - 1, chunk_rows=size)
    row = F.struct("_g", F.array(*[F.col(c).cast("double") for c in cols]).alias("x"),
                   F.col(target).cast("double").alias("y"))
    return (frame.groupBy(*keys, "_chunk")
            .agg(F.array_sort(F.collect_list(row)).alias("_r"), F.first("_n").alias("n"))
            .select(*keys, (F.col("_chunk") * F.lit(size)).cast("bigint").alias("first"),
                    F.col("n").cast("bigint").alias("n"), F.lit(size).cast("bigint").alias("size"),
                    F.flatten("_r.x").alias("xs"), F.col("_r.y").alias("ys")))


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage is cut and Spark
    plans joins from the file sizes it measures."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def chunk_gradient(theta, values: np.ndarray, targets: np.ndarray, b: int, starts: int, last_only: bool = False):
    """M3 over the first ``starts`` windows of a chunk: (gradient, loss,
    scored steps, windows). ``last_only`` scores the last step alone."""
    theta = np.asarray(theta, dtype=np.float64)
    X, Y = windows_of(values, targets, b, include_last=True)
    X, Y = X[:max(starts, 0)], Y[:max(starts, 0)]
    grad, loss, steps, windows = np.zeros_like(theta), 0.0, 0, 0
    slab = max(1, SLAB_STEPS // b)
    for k in range(0, len(X), slab):
        x, y = X[k:k + slab], Y[k:k + slab]
        whole = ~np.isnan(x).any(axis=(1, 2))
        if not whole.all():
            x, y = x[whole], y[whole]
        if not len(x):
            continue
        if last_only:
            y = np.concatenate([np.full((len(y), b - 1), np.nan), y[:, -1:]], axis=1)
        g, l, s = backward(theta, x, y)
        grad, loss, steps, windows = grad + g, loss + l, steps + s, windows + len(x)
    return grad, loss, steps, windows


def gradient_rows(chunks: DataFrame, n_features: int, keys: Sequence[str] = (), theta=None, b: int | None = None,
                  last_only: bool = False) -> DataFrame:
    """M3: one gradient row per chunk and parameter set.

    Either all chunks share ``theta`` and ``b``, or each carries its sets in
    the column ``sets`` (array of grid_id, b, theta), so that a chunk is read
    once for all points of a grid."""
    keys = list(keys)
    fixed = None if theta is None else [{"grid_id": 0, "b": int(b), "theta": np.asarray(theta, dtype=np.float64)}]
    schema = T.StructType([*[chunks.schema[k] for k in keys], T.StructField("grid_id", T.IntegerType()),
                           T.StructField("grad", T.ArrayType(T.DoubleType())), T.StructField("loss", T.DoubleType()),
                           T.StructField("steps", T.LongType()), T.StructField("windows", T.LongType())])

    def run(batches):
        for pdf in batches:
            out = []
            for i in range(len(pdf)):
                r = pdf.iloc[i]
                vals = np.asarray(r["xs"], dtype=np.float64).reshape(-1, n_features)
                ys = np.asarray(r["ys"], dtype=np.float64)
                for p in (fixed if fixed is not None else r["sets"]):
                    starts = min(int(r["size"]), int(r["n"]) - p["b"] - int(r["first"]))
                    g, l, s, w = chunk_gradient(p["theta"], vals, ys, p["b"], starts, last_only)
                    out.append((*[r[k] for k in keys], int(p["grid_id"]), g.tolist(), float(l), int(s), int(w)))
            yield pd.DataFrame(out, columns=schema.names)

    cols = [*keys, "first", "n", "size", "xs", "ys", *([] if fixed is not None else ["sets"])]
    return chunks.select(*cols).mapInPandas(run, schema)


def _summed(grads: DataFrame, size: int, by: Sequence[str]) -> DataFrame:
    return grads.groupBy(*by).agg(
        F.array(*[F.sum(F.col("grad")[k]) for k in range(size)]).alias("grad"), F.sum("loss").alias("loss"),
        F.sum("steps").alias("steps"), F.sum("windows").alias("windows"))


def sum_gradients(grads: DataFrame, size: int):
    """A8 over all rows: (gradient, loss, steps), one row for the driver."""
    r = _summed(grads, size, []).first()
    if r["steps"] is None:
        return np.zeros(size), 0.0, 0
    return np.asarray(r["grad"], dtype=np.float64), float(r["loss"]), int(r["steps"])


def train_distributed(chunks: DataFrame, n_features: int, b: int, epochs: int = 4, lr: float = 0.1, theta=None,
                      seed: int = 0, last_only: bool = False):
    """M6: one parameter set for the windows of all series in ``chunks``
    (``pack_series``). Returns (theta, mean loss per epoch)."""
    th = init_theta(n_features, seed) if theta is None else np.asarray(theta, dtype=np.float64)
    chunks = stored_table(chunks, "chunks")
    history = []
    for _ in range(epochs):
        g, loss, steps = sum_gradients(gradient_rows(chunks, n_features, theta=th, b=b, last_only=last_only), th.size)
        th = sgd_step(th, g / max(steps, 1), lr)
        history.append(loss / max(steps, 1))
    return th, history


def train_per_symbol(rows: DataFrame, cols: Sequence[str], target: str, b: int, epochs: int = 2, lr: float = 0.01,
                     keys: Sequence[str] = ("symbol",), seed: int = 0, init: DataFrame | None = None,
                     version: int = 1, grid: Sequence[dict] | None = None, bucket: str = "day",
                     chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One parameter set per key (and grid point), trained on
    all windows of the key.

    ``init`` (keys, theta) starts from stored parameters (M7), keys without
    them and all others from ``init_theta_column``. ``grid`` lists points
    (b, epochs, lr) that share every pass over the chunks. Output: (keys,
    [grid_id,] version, theta, loss, windows), where loss is the mean of the
    last epoch, taken before its update."""
    keys = list(keys)
    points = [dict(b=b, epochs=epochs, lr=lr)] if grid is None else list(grid)
    size = len(GATES) * (len(cols) + 2)
    chunks = stored_table(pack_series(rows, cols, target, max(int(p["b"]) for p in points), keys, bucket, chunk_rows),
                          "chunks")
    fresh = init_theta_column(keys[0], len(cols), seed)
    params = chunks.select(*keys).distinct()
    if init is None:
        params = params.withColumn("theta", fresh)
    else:
        params = (params.join(init.select(*keys, F.col("theta").alias("_t")), keys, "left")
                  .withColumn("theta", F.coalesce("_t", fresh)).drop("_t"))
    point = F.array(*[F.struct(F.lit(i).alias("grid_id"), F.lit(int(p["b"])).alias("b"),
                               F.lit(int(p["epochs"])).alias("epochs"), F.lit(float(p["lr"])).alias("lr"))
                      for i, p in enumerate(points)])
    params = stored_table(params.withColumn("_p", F.explode(point)).select(
        *keys, "_p.*", "theta", F.lit(None).cast("double").alias("loss"), F.lit(0).cast("bigint").alias("windows")),
        "theta-0")
    ids = [*keys, "grid_id"]
    for e in range(max(int(p["epochs"]) for p in points)):
        sets = (params.where(F.col("epochs") > e).groupBy(*keys)
                .agg(F.collect_list(F.struct("grid_id", "b", "theta")).alias("sets")))
        got = _summed(gradient_rows(chunks.join(sets, keys), len(cols), keys), size, ids).select(
            *ids, "grad", "steps", F.col("loss").alias("_l"), F.col("windows").alias("_w"))
        moved = F.zip_with("theta", "grad", lambda p, g: p - F.col("lr") * g / F.col("steps"))
        active = F.col("steps") > 0
        params = stored_table(params.join(got, ids, "left").select(
            *ids, "b", "epochs", "lr", F.when(active, moved).otherwise(F.col("theta")).alias("theta"),
            F.when(active, F.col("_l") / F.col("steps")).otherwise(F.col("loss")).alias("loss"),
            F.coalesce("_w", "windows").alias("windows")), f"theta-{e + 1}")
    out = params.withColumn("version", F.lit(int(version)).cast("bigint"))
    return out.select(*(ids if grid is not None else keys), "version", "theta", "loss", "windows")


def update_in_order(theta, values: np.ndarray, targets: np.ndarray, b: int, starts: int, lr: float):
    """M5 over the first ``starts`` windows of ``b`` rows: after each window the
    parameters move against its gradient, summed over its steps. Returns
    (theta, loss, scored steps, windows); losses are taken before the update.

    Input products and everything that the backward pass needs from one step
    alone are array code over the window; what goes from step to step is a loop
    over plain numbers, which is faster than arrays of one element."""
    n_features = values.shape[1]
    th = np.array(theta, dtype=np.float64).reshape(len(GATES), n_features + 2)
    loss, steps, windows, tanh = 0.0, 0, 0, math.tanh
    bad = np.concatenate([[0], np.cumsum(np.isnan(values).any(axis=1))])
    state = np.empty((6, b + 1))                       # a, i, f, o per step; c and h with a zero before them
    for k in range(max(starts, 0)):
        if bad[k + b] > bad[k]:
            continue
        x, y = values[k:k + b], targets[k:k + b]
        ua, ui, uf, uo = th[:, n_features].tolist()
        h = c = 0.0
        rows = []
        for za, zi, zf, zo in (x @ th[:, :n_features].T + th[:, n_features + 1]).tolist():
            a = tanh(za + ua * h)
            i = 0.5 + 0.5 * tanh(0.5 * (zi + ui * h + SIGMOID_EPS))
            f = 0.5 + 0.5 * tanh(0.5 * (zf + uf * h + SIGMOID_EPS))
            o = 0.5 + 0.5 * tanh(0.5 * (zo + uo * h + SIGMOID_EPS))
            c = a * i + f * c
            h = tanh(c) * o
            rows.append((a, i, f, o, c, h))
        state[:, 0] = 0.0
        state[:, 1:] = np.array(rows).T
        a, i, f, o = state[:4, 1:]
        c, h, c_prev, h_prev = state[4, 1:], state[5, 1:], state[4, :-1], state[5, :-1]
        known = ~np.isnan(y)
        err = np.where(known, h - y, 0.0)
        tc = np.tanh(c)
        through = zip(err[::-1].tolist(), (o * (1 - tc * tc))[::-1].tolist(), (i * (1 - a * a))[::-1].tolist(),
                      (a * i * (1 - i))[::-1].tolist(), (c_prev * f * (1 - f))[::-1].tolist(),
                      (tc * o * (1 - o))[::-1].tolist(), f[::-1].tolist())
        dh = dc = f_next = 0.0
        deltas = []
        for e, kc, ka, ki, kf, ko, gate in through:
            out = e + dh
            dc = out * kc + dc * f_next
            da, di, df, do = dc * ka, dc * ki, dc * kf, out * ko
            dh = da * ua + di * ui + df * uf + do * uo
            f_next = gate
            deltas.append((da, di, df, do))
        d = np.array(deltas[::-1])
        th[:, :n_features] -= lr * (d.T @ x)
        th[:, n_features] -= lr * (h_prev @ d)
        th[:, n_features + 1] -= lr * d.sum(axis=0)
        loss += float(err @ err) / 2.0
        steps += int(known.sum())
        windows += 1
    return th.reshape(-1), loss, steps, windows


def _wave(chunks: DataFrame, n_features: int, keys: Sequence[str]) -> DataFrame:
    """One wave: (keys, grid_id, theta, loss, steps, windows) after the chunk's
    windows, or after all epochs where the chunk holds the whole series."""
    schema = T.StructType([*[chunks.schema[k] for k in keys], T.StructField("grid_id", T.IntegerType()),
                           T.StructField("theta", T.ArrayType(T.DoubleType())), T.StructField("loss", T.DoubleType()),
                           T.StructField("steps", T.LongType()), T.StructField("windows", T.LongType())])

    def run(batches):
        for pdf in batches:
            out = []
            for i in range(len(pdf)):
                r = pdf.iloc[i]
                vals = np.asarray(r["xs"], dtype=np.float64).reshape(-1, n_features)
                ys = np.asarray(r["ys"], dtype=np.float64)
                whole = int(r["n"]) <= int(r["size"])
                for p in r["sets"]:
                    starts = min(int(r["size"]), int(r["n"]) - p["b"] - int(r["first"]))
                    got = (p["theta"], 0.0, 0, 0)
                    for _ in range(p["epochs"] if whole else 1):
                        got = update_in_order(got[0], vals, ys, p["b"], starts, p["lr"])
                    out.append((*[r[k] for k in keys], int(p["grid_id"]), list(map(float, got[0])), *got[1:]))
            yield pd.DataFrame(out, columns=schema.names)

    return chunks.select(*keys, "first", "n", "size", "xs", "ys", "sets").mapInPandas(run, schema)


def train_in_order(rows: DataFrame, cols: Sequence[str], target: str, b: int, epochs: int = 2, lr: float = 0.01,
                   keys: Sequence[str] = ("symbol",), seed: int = 0, init: DataFrame | None = None,
                   version: int = 1, grid: Sequence[dict] | None = None, bucket: str = "day",
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """M5, M7 and M10 with an update after each window, in order; arguments and
    output as in ``train_per_symbol``. Chunks are stored by wave, so a wave
    reads its own files; only parameters, one row per key and grid point, go
    from wave to wave."""
    keys = list(keys)
    points = [dict(b=b, epochs=epochs, lr=lr)] if grid is None else list(grid)
    spark = rows.sparkSession
    path = scratch_path(spark, "waves")
    (pack_series(rows, cols, target, max(int(p["b"]) for p in points), keys, bucket, chunk_rows)
     .withColumn("wave", (F.col("first") / F.col("size")).cast("int")).write.partitionBy("wave").parquet(path))
    fields = T.StructType([f for f in rows.schema.fields if f.name in keys])
    schema = T.StructType([*fields, *T.StructType.fromDDL(
        "first long, n long, size long, xs array<double>, ys array<double>, wave int")])
    chunks = spark.read.schema(schema).parquet(path)
    fresh = init_theta_column(keys[0], len(cols), seed)
    params = chunks.where("wave = 0").select(*keys)
    if init is None:
        params = params.withColumn("theta", fresh)
    else:
        params = (params.join(init.select(*keys, F.col("theta").alias("_t")), keys, "left")
                  .withColumn("theta", F.coalesce("_t", fresh)).drop("_t"))
    point = F.array(*[F.struct(F.lit(i).alias("grid_id"), F.lit(int(p["b"])).alias("b"),
                               F.lit(int(p["epochs"])).alias("epochs"), F.lit(float(p["lr"])).alias("lr"))
                      for i, p in enumerate(points)])
    ids = [*keys, "grid_id"]
    nothing = [F.lit(0.0).alias("loss"), F.lit(0).cast("bigint").alias("steps"), F.lit(0).cast("bigint").alias("windows")]
    params = stored_table(params.withColumn("_p", F.explode(point)).select(*keys, "_p.*", "theta", *nothing), "theta-0")
    waves = int(chunks.agg(F.max("wave")).first()[0] or 0) + 1
    for e in range(max(int(p["epochs"]) for p in points)):
        for k in range(waves):
            relay = chunks.where(F.col("wave") == k)
            if e:                                 # series of one chunk ran all their epochs in the first wave
                if waves == 1:
                    break
                relay = relay.where("n > size")
            sets = (params.where(F.col("epochs") > e).groupBy(*keys)
                    .agg(F.collect_list(F.struct("grid_id", "b", "epochs", "lr", "theta")).alias("sets")))
            got = _wave(relay.join(sets, keys), len(cols), keys).select(
                *ids, F.col("theta").alias("_theta"), *[F.col(c).alias(f"_{c}") for c in ("loss", "steps", "windows")])
            ran = F.col("_theta").isNotNull()
            # The first wave of an epoch starts its sums anew.
            sums = [F.when(ran, F.col(f"_{c}") + (F.lit(0) if k == 0 else F.col(c))).otherwise(F.col(c)).alias(c)
                    for c in ("loss", "steps", "windows")]
            params = stored_table(params.join(got, ids, "left").select(
                *ids, "b", "epochs", "lr", F.coalesce("_theta", "theta").alias("theta"), *sums), f"theta-{e}-{k}")
    out = params.withColumn("version", F.lit(int(version)).cast("bigint")).withColumn(
        "loss", F.when(F.col("steps") > 0, F.col("loss") / F.col("steps")))
    return out.select(*(ids if grid is not None else keys), "version", "theta", "loss", "windows")
