"""End-to-end forecasting plans over bars.

``forecast_pairs`` is the engine's flagship: trades -> bars (R1) -> per-symbol
min-max scaling (A1, F3) -> windows of the previous ``b`` bars (W2) -> LSTM
fold (M1) -> unscaled prediction (F4) -> prediction made on bar t-1 beside the
close of bar t (J3). ``forecast_error`` reduces the pairs to error metrics
per symbol (A7).

Physical shape: one partial aggregation for the bars, one exchange on
(symbol, day) to number rows, one small per-symbol aggregate (the scaler),
and one exchange on (symbol, chunk) for the windows; the scaler and offset
tables are joined as AQE sees fit (broadcast when small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import minmax_inverse, minmax_scale
from ..operators.bars import ticks_to_bars
from ..operators.features import trailing_windows
from ..operators.lstm import FIXED_TEST_WEIGHTS, lstm_fold
from ..operators.series import DEFAULT_CHUNK_ROWS, index_series
from ..session import materialize

FEATURES = ("close", "volume")


def series_scaler(idx: DataFrame, features=FEATURES, target: str = "close") -> DataFrame:
    """Per symbol of a numbered series: min and max of the features and of the
    target."""
    aggs = []
    for c in features:
        aggs += [F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max")]
    later = F.when(F.col("_g") >= 1, F.col(target).cast("double"))
    aggs += [F.min(later).alias("target_min"), F.max(later).alias("target_max")]
    return idx.groupBy("symbol").agg(*aggs)


def scaled_bars(bars: DataFrame, features=FEATURES, target: str = "close", bucket: str = "day",
                materialize_bars: bool = True) -> DataFrame:
    """Index bars and attach per-symbol scaler columns.

    The target of bar t is the close of bar t+1, so the target scaler is the
    min/max of ``target`` over every bar but the first (the mean fill of the
    last target lies inside that range and cannot move it).

    The bars feed three branches (numbering, bucket counts, scaler); each
    prunes other columns, so without ``materialize_bars`` Spark would
    aggregate the raw trades once per branch. Bars are much smaller than
    trades, so they are written once to the shared folder instead.
    """
    if materialize_bars:
        bars = materialize(bars)
    idx = index_series(bars, ["symbol"], ["ts"], bucket)
    scaler = series_scaler(idx, features, target)
    out = idx.join(scaler, "symbol", "inner")
    for c in features:
        out = out.withColumn(f"{c}_s", minmax_scale(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")))
    return out


def forecast_pairs(ticks: DataFrame, width: str = "1 hour", b: int = 4, weights=None,
                   bucket: str = "day", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """(symbol, ts, actual, predicted): prediction from the b bars before ts."""
    weights = weights or FIXED_TEST_WEIGHTS
    bars = ticks_to_bars(ticks, width)
    sc = scaled_bars(bars, FEATURES, "close", bucket)
    win = trailing_windows(sc, [f"{c}_s" for c in FEATURES], b, exclude_current=True,
                           keep=["close", "target_min", "target_max"], bucket=bucket, chunk_rows=chunk_rows)
    h = lstm_fold(F.col("xs"), weights, len(FEATURES))
    return win.select("symbol", "ts", F.col("close").alias("actual"),
                      minmax_inverse(h, F.col("target_min"), F.col("target_max")).alias("predicted"))


def error_metrics(pairs: DataFrame, actual: str = "actual", predicted: str = "predicted",
                  keys=("symbol",)) -> DataFrame:
    """Pairs, MAE, RMSE and mean half squared error per key."""
    err = F.col(actual) - F.col(predicted)
    return (pairs.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("pairs"),
                 F.avg(F.abs(err)).alias("mae"),
                 F.sqrt(F.avg(err * err)).alias("rmse"),
                 F.avg(err * err / F.lit(2.0)).alias("loss")))


def forecast_error(ticks: DataFrame, width: str = "1 hour", b: int = 4, **kw) -> DataFrame:
    return error_metrics(forecast_pairs(ticks, width, b, **kw))
