"""LSTM training plans (M2, M5-M7, M10, M11) over bars derived from the
driver tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import minmax_inverse, minmax_scale
from ..operators import bars as B
from ..operators import features as X
from ..operators import lstm as L
from ..operators import lstm_train as LT
from ..session import materialize, scratch_path
from . import forecast

# Reference features of a bar, in file order, and the defaults of the main
# program: window 72, 4 epochs, learning rate 1; its rolling dataset (L2)
# holds 288 bars.
BAR_FEATURES = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]
MAIN_WINDOW, MAIN_EPOCHS, MAIN_LR, ROLLING_CAPACITY = 72, 4, 1.0, 288


def scaled_series(bars: DataFrame, features, bucket: str = "day") -> DataFrame:
    """Numbered bars with next-close targets (W1, A2), min-max scaled per
    symbol (A1, F3). The bars are written once: numbering, target mean and
    scaler would each aggregate the trades again."""
    lt = X.lead_target(materialize(bars), "close", "target", keep_index=True, bucket=bucket)
    fit = X.fit_minmax(lt, [*features, "target"])
    return X.apply_minmax(lt, fit, [*features, "target"], suffix="_s")


def train_symbols(bars: DataFrame, b: int = MAIN_WINDOW, epochs: int = MAIN_EPOCHS, lr: float = MAIN_LR,
                  seed: int = 0, init: DataFrame | None = None, version: int = 1, grid=None) -> DataFrame:
    """One parameter set per symbol over all its bars, updated after
    every window in order."""
    rows = scaled_series(bars, BAR_FEATURES)
    return LT.train_in_order(rows, [f"{c}_s" for c in BAR_FEATURES], "target_s", b, epochs, lr,
                               seed=seed, init=init, version=version, grid=grid)


def warm_start(spark: SparkSession, bars: DataFrame, model_path: str | None = None, b: int = MAIN_WINDOW,
               epochs: int = MAIN_EPOCHS, lr: float = MAIN_LR) -> DataFrame:
    """M7: train v1, store it (K5), load the newest version, continue
    training on the same bars as v2, store and return v2."""
    path = model_path or scratch_path(spark, "lstm-params")
    nf = len(BAR_FEATURES)
    v1 = train_symbols(bars, b, epochs, lr, version=1)
    L.save_params(L.thetas_to_params(v1, nf), path)
    init = L.theta_column(L.load_params(spark, path))
    v2 = train_symbols(bars, b, epochs, lr, init=init.select("symbol", "theta"), version=2)
    p2 = L.thetas_to_params(v2, nf)
    L.save_params(p2, path)
    return L.load_params(spark, path).where(F.col("version") == 2)


def pooled_chunks(bars: DataFrame, b: int, features=("close", "volume")) -> DataFrame:
    """Packed series of every symbol, scaled per symbol, for M6."""
    return LT.pack_series(scaled_series(bars, features), [f"{c}_s" for c in features], "target_s", b)


def train_pooled(spark: SparkSession, bars: DataFrame, b: int = 24, epochs: int = 3, lr: float = 0.5,
                 seed: int = 0) -> DataFrame:
    """M6: full-batch training over all windows; (epoch, loss, theta)."""
    th, hist = LT.train_distributed(pooled_chunks(bars, b), 2, b, epochs, lr, seed=seed)
    rows = [(i + 1, float(l), th.tolist() if i == len(hist) - 1 else None) for i, l in enumerate(hist)]
    schema = T.StructType([T.StructField("epoch", T.IntegerType()), T.StructField("loss", T.DoubleType()),
                           T.StructField("theta", T.ArrayType(T.DoubleType()))])
    return spark.createDataFrame(rows, schema)


def forecast_pairs_bulk(ticks: DataFrame, width: str = "1 hour", b: int = 4, theta=None,
                        chunk_rows: int = 1 << 17) -> DataFrame:
    """M2 twin of ``forecast.forecast_pairs``: the same windows scored by
    numpy inside ``applyInPandas`` instead of the Catalyst fold."""
    theta = L.theta_from_gates(L.FIXED_TEST_WEIGHTS) if theta is None else np.asarray(theta)
    bars = B.ticks_to_bars(ticks, width)
    sc = forecast.scaled_bars(bars)
    h = L.score_bulk(sc, ["close_s", "volume_s"], b, theta, exclude_current=True, chunk_rows=chunk_rows,
                     keep=["close", "target_min", "target_max"])
    return h.select("symbol", "ts", F.col("close").alias("actual"),
                    minmax_inverse(F.col("h"), F.col("target_min"), F.col("target_max")).alias("predicted"))


def lag60_forecast(spark: SparkSession, daily: DataFrame, k: int = 60, epochs: int = 5, lr: float = 0.5,
                   seed: int = 0, column: str = "close") -> DataFrame:
    """Forecaster on the ``k`` previous daily values of ``column``.

    Scaler fitted on the train split only (A1); the one-unit LSTM is trained
    (M6) on the windows of ``k`` train rows whose next row is a train row, too;
    the test rows are scored with their ``k``-row context, which reaches back
    into train (L3, M2), and unscaled (F4). Output: (symbol, ts, real,
    predicted).
    """
    sp = X.lead_target(materialize(daily), column, "target", fill_mean=False, keep_index=True, bucket="year")
    sp = B.chronological_split(sp, keep_index=True)
    in_train = F.col("split") == "train"
    fit = X.fit_minmax(sp.where(in_train), [column])
    sc = materialize(X.apply_minmax(sp, fit, [column], suffix="_s").withColumn(
        "target_s", minmax_scale(F.col("target"), F.col(f"{column}_min"), F.col(f"{column}_max"))))
    n_train = (F.col("_n") - F.ceil(F.col("_n") * F.lit(0.2))).cast("bigint")
    train = sc.where(in_train).withColumn("_n", n_train)
    chunks = LT.pack_series(train, [f"{column}_s"], "target_s", k)
    th, _ = LT.train_distributed(chunks, 1, k, epochs, lr, seed=seed, last_only=True)
    scored = L.score_bulk(sc, [f"{column}_s"], k, th, keep=[column, "split", f"{column}_min", f"{column}_max"])
    return scored.where(F.col("split") == "test").select(
        "symbol", "ts", F.col(column).alias("real"),
        minmax_inverse(F.col("h"), F.col(f"{column}_min"), F.col(f"{column}_max")).alias("predicted"))
