"""Feature operators: scaling (A1, A2, F3-F5), analytic windows (W1-W4) and
key-based pairing (J1-J3).

All ordered operators go through ``series.index_series`` + ``series.chunked``
so that no window holds a whole symbol.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import minmax_inverse, minmax_scale
from .series import DEFAULT_CHUNK_ROWS, chunked, ensure_index, own_rows


def _keys(keys) -> list:
    return [keys] if isinstance(keys, str) else list(keys)


# ------------------------------------------------------------- A1 / F3 / F4

def fit_minmax(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """A1: per-key min and max of each column -> (keys, <c>_min, <c>_max).

    A plain partial aggregation; the result has one row per key.
    """
    keys = _keys(keys)
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max")]
    return df.groupBy(*keys).agg(*aggs)


def fit_minmax_long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """A1 in long form: (keys, feature, min_value, max_value), the stored
    scaler state."""
    wide = fit_minmax(df, cols, keys)
    keys = _keys(keys)
    parts = ", ".join(f"'{c}', `{c}_min`, `{c}_max`" for c in cols)
    return wide.select(*keys, F.expr(f"stack({len(cols)}, {parts}) as (feature, min_value, max_value)"))


def apply_minmax(df: DataFrame, scaler: DataFrame, cols: Sequence[str],
                 keys: Sequence[str] = ("symbol",), suffix: str = "") -> DataFrame:
    """Scale ``cols`` with a fitted (possibly older) scaler.

    The scaler has one row per key; the join is planned by AQE, which turns it
    into a broadcast when the measured size is small and keeps a shuffle join
    otherwise.
    """
    keys = _keys(keys)
    out = df.join(scaler, keys, "inner")
    for c in cols:
        out = out.withColumn(c + suffix, minmax_scale(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")))
    return out


def invert_minmax(df: DataFrame, col: str, lo: str, hi: str, out: str | None = None) -> DataFrame:
    """F4."""
    return df.withColumn(out or col, minmax_inverse(F.col(col), F.col(lo), F.col(hi)))


# ------------------------------------------------------------- W1 / A2

def lead_target(bars: DataFrame, col: str = "close", out: str = "target",
                keys: Sequence[str] = ("symbol",), fill_mean: bool = True,
                bucket: str = "day", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                keep_index: bool = False) -> DataFrame:
    """Next row's ``col`` as target; the last row of each key gets the
    mean of the known targets (A2) when ``fill_mean``.

    ``keep_index`` keeps ``_g``/``_n`` (rows are neither added nor removed),
    so a following ordered operator reuses the numbering.
    """
    keys = _keys(keys)
    idx = ensure_index(bars, keys, bucket)
    frame, w = chunked(idx, keys, fwd=1, chunk_rows=chunk_rows)
    frame = frame.withColumn(out, F.lead(col, 1).over(w))
    res = own_rows(frame)
    if not keep_index:
        res = res.drop("_g", "_n")
    if not fill_mean:
        return res
    # A2: mean of the known targets per key. The known targets are exactly
    # the values at positions >= 1, so the mean is a partial aggregate over the
    # numbered rows, not over the window output (which would run the window
    # pass a second time).
    means = idx.where(F.col("_g") >= 1).groupBy(*keys).agg(F.avg(col).alias("_mean_target"))
    return (res.join(means, keys, "inner")
            .withColumn(out, F.coalesce(F.col(out), F.col("_mean_target")))
            .drop("_mean_target"))


# ------------------------------------------------------------- W2 windows

def sequence_windows(df: DataFrame, cols: Sequence[str], b: int, target: str | None = None,
                     keys: Sequence[str] = ("symbol",), include_last: bool = False,
                     bucket: str = "day", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Overlapping windows of ``b`` consecutive rows, stride 1.

    Window ``win_id = i`` holds rows i..i+b-1 of its key. Like the reference,
    a window is kept only while a row follows it (``i + b < n``, n-b windows);
    ``include_last=True`` also keeps the final full window.

    Output: (keys, win_id, start_ts, end_ts, xs array<array<double>>[, ys]).
    """
    if b < 1:
        raise ValueError("window length must be positive")
    keys = _keys(keys)
    idx = ensure_index(df, keys, bucket)
    frame, w = chunked(idx, keys, fwd=b - 1, chunk_rows=max(chunk_rows, b))
    fw = w.rowsBetween(0, b - 1)
    x = F.array(*[F.col(c).cast("double") for c in cols])
    frame = frame.withColumn("xs", F.collect_list(x).over(fw))
    frame = frame.withColumn("end_ts", F.last("ts").over(fw))
    if target:
        frame = frame.withColumn("ys", F.collect_list(F.col(target).cast("double")).over(fw))
    limit = F.col("_n") - F.lit(b) + (F.lit(1) if include_last else F.lit(0))
    out = own_rows(frame).where(F.col("_g") < limit)
    sel = [*keys, F.col("_g").alias("win_id"), F.col("ts").alias("start_ts"), "end_ts", "xs"]
    if target:
        sel.append("ys")
    return out.select(*sel)


def trailing_windows(df: DataFrame, cols: Sequence[str], b: int, keys: Sequence[str] = ("symbol",),
                     exclude_current: bool = False, keep=(), bucket: str = "day",
                     chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Windows that end at (or, with ``exclude_current``, just before) each row.

    Used for scoring: the window ending at bar t-1 predicts bar t. Rows
    without a full history are dropped. Output keeps ``keep`` columns.
    """
    keys = _keys(keys)
    idx = ensure_index(df, keys, bucket)
    back = b if exclude_current else b - 1
    frame, w = chunked(idx, keys, back=back, chunk_rows=max(chunk_rows, b + 1))
    fw = w.rowsBetween(-b, -1) if exclude_current else w.rowsBetween(-(b - 1), 0)
    x = F.array(*[F.col(c).cast("double") for c in cols])
    frame = frame.withColumn("xs", F.collect_list(x).over(fw))
    out = own_rows(frame).where(F.col("_g") >= F.lit(back))
    return out.select(*keys, "ts", F.col("_g").alias("pos"), *keep, "xs")


# ------------------------------------------------------------- W3 / W4

def lag_features(df: DataFrame, col: str, k: int = 60, keys: Sequence[str] = ("symbol",),
                 out_x: str = "xs", out_y: str = "y", bucket: str = "day",
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Previous ``k`` values of ``col`` -> the current value; n-k rows."""
    keys = _keys(keys)
    idx = ensure_index(df, keys, bucket)
    frame, w = chunked(idx, keys, back=k, chunk_rows=max(chunk_rows, k))
    frame = frame.withColumn(out_x, F.collect_list(F.col(col).cast("double")).over(w.rowsBetween(-k, -1)))
    out = own_rows(frame).where(F.col("_g") >= F.lit(k))
    return out.select(*keys, "ts", F.col("_g").alias("pos"), out_x, F.col(col).cast("double").alias(out_y))


def lag_column(df: DataFrame, col: str, out: str, keys: Sequence[str] = ("symbol",),
               bucket: str = "day", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Previous row's ``col`` per key."""
    keys = _keys(keys)
    idx = ensure_index(df, keys, bucket)
    frame, w = chunked(idx, keys, back=1, chunk_rows=chunk_rows)
    frame = frame.withColumn(out, F.lag(col, 1).over(w))
    return own_rows(frame).drop("_g", "_n")


# ------------------------------------------------------------- J1-J3

def align_xy(features: DataFrame, targets: DataFrame, keys: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """Features beside targets stored apart, equi-join on (symbol, ts).

    Both sides are large; a sort-merge join on the full key spreads a hot
    symbol over many partitions because ``ts`` is part of the key.
    """
    return features.join(targets, list(keys), "inner")


def attach_params(bars: DataFrame, params: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Latest parameters per key beside each bar.

    ``params`` may hold several versions; the newest per key is selected by a
    partial aggregate. Spark broadcasts the side if its measured size allows.
    """
    keys = _keys(keys)
    if "version" in params.columns:
        rest = [c for c in params.columns if c not in keys and c != "version"]
        params = (params.groupBy(*keys)
                  .agg(F.max_by(F.struct(*rest), "version").alias("_p"), F.max("version").alias("version"))
                  .select(*keys, "version", "_p.*"))
    return bars.join(params, keys, "inner")


def pair_actual_predicted(scored: DataFrame, actual: str = "close", predicted: str = "predicted",
                          keys: Sequence[str] = ("symbol",), bucket: str = "day",
                          chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The prediction made on bar t-1 beside the actual value of bar t.

    The first bar of a key has no earlier prediction and emits nothing.
    """
    keys = _keys(keys)
    lagged = lag_column(scored, predicted, "_prev", keys, bucket, chunk_rows)
    return (lagged.where(F.col("_prev").isNotNull())
            .select(*keys, "ts", F.col(actual).alias("actual"), F.col("_prev").alias("predicted")))

