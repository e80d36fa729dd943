"""Keyed streaming state (ST4, ST5) with ``transformWithStateInPandas``, and
the writers that retrain and score between micro-batches (ST5, ST6).

State per symbol: the last ``b`` scaled bars (ST5) or the previous prediction
(ST4), the time of the newest processed bar, and, with a ``delay``, the bars
held back, one entry of a map state each, with a timer at its time. A batch
writes its own bars and what the watermark released, not the rest of the held
bars.

With a ``delay``, bars are taken in event time: each is held until the watermark
(newest bar time seen minus ``delay``) has passed it and its timer fires; timers
fire in the order of their times, so bars that arrive out of order within the
delay are processed in their order; older ones are late. The newest bars of a
stream come out once a bar more than ``delay`` newer has been seen. Without a
``delay`` the source must deliver bars in time order across micro-batches. Of
bars of equal times the first counts.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.streaming import StatefulProcessor

from ..functions.scalar import minmax_scale
from ..operators import lstm as L
from .store import VersionedStore


def _micros(ts: pd.Series) -> np.ndarray:
    s = pd.to_datetime(ts)
    if getattr(s.dt, "tz", None) is not None:
        s = s.dt.tz_convert("UTC").dt.tz_localize(None)
    return s.astype("datetime64[us]").astype("int64").to_numpy()


PAIR_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("ts", T.TimestampType()),
                            T.StructField("actual", T.DoubleType()), T.StructField("predicted", T.DoubleType())])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Hands the rows of a key to ``step`` in the order of their times: rows
    are [bar time in microseconds, values of ``cols``], whose names must not
    start with an underscore (they pass through named tuples)."""

    def __init__(self, cols: Sequence[str], delayed: bool):
        self.cols, self.delayed = list(cols), delayed

    def init(self, handle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", "us long")
        if self.delayed:
            self.held = handle.getMapState("held", "ms long", "rows array<array<double>>")
        self.open(handle)

    def open(self, handle) -> None:
        """Create the states of ``step``."""

    def step(self, key, rows: np.ndarray) -> pd.DataFrame:
        raise NotImplementedError

    def _process(self, key, rows: np.ndarray):
        last = self.done.get()
        if last is not None:
            rows = rows[rows[:, 0] > last[0]]
        if len(rows):
            yield self.step(key, rows)
            self.done.update((int(rows[-1, 0]),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [np.column_stack([_micros(pdf["ts"]).astype(np.float64), pdf[self.cols].to_numpy(np.float64)])
                 for pdf in rows if len(pdf)]
        new = np.vstack(parts) if parts else np.zeros((0, len(self.cols) + 1))
        new = new[np.unique(new[:, 0], return_index=True)[1]]
        if not self.delayed:
            yield from self._process(key, new)
            return
        last = self.done.get()
        if last is not None:
            new = new[new[:, 0] > last[0]]
        times = (new[:, 0] // 1000).astype(np.int64)
        for ms in np.unique(times).tolist():
            part = new[times == ms].tolist()
            if self.held.containsKey((ms,)):
                old = [list(r) for r in self.held.getValue((ms,))[0]]
                known = {r[0] for r in old}
                part = old + [r for r in part if r[0] not in known]
            else:
                self.handle.registerTimer(ms + 1)
            self.held.updateValue((ms,), (part,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ms = (expiredTimerInfo.getExpiryTimeInMs() - 1,)
        rows = np.array([list(r) for r in self.held.getValue(ms)[0]], dtype=np.float64)
        self.held.removeKey(ms)
        yield from self._process(key, rows[np.argsort(rows[:, 0])])

    def close(self) -> None:
        pass


def _pairs(key, rows: np.ndarray, actual, predicted) -> pd.DataFrame:
    return pd.DataFrame({"symbol": np.full(len(rows), key[0], dtype=object),
                         "ts": pd.to_datetime(rows[:, 0].astype(np.int64), unit="us"),
                         "actual": np.asarray(actual, np.float64), "predicted": np.asarray(predicted, np.float64)})


def _event_time(rows: DataFrame, delay: str | None) -> DataFrame:
    """Watermark of the whole source, before any join: bars of a symbol without
    a scaler move it, too."""
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    return rows if delay is None else rows.withWatermark("ts", delay)


def _keyed(s: DataFrame, processor: InOrder) -> DataFrame:
    """Map states and timers need the RocksDB state store."""
    s.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return s.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=PAIR_SCHEMA, outputMode="Append",
        timeMode="EventTime" if processor.delayed else "None")


class Scores(InOrder):
    """ST5: the last ``b`` inputs of a key score the next bar."""

    def __init__(self, theta: np.ndarray, b: int, n_features: int, delayed: bool):
        super().__init__([*[f"x{j}" for j in range(n_features)], "close", "target_min", "target_max"], delayed)
        self.theta, self.b, self.n_features = theta, b, n_features

    def open(self, handle) -> None:
        self.hist = handle.getValueState("hist", "xs array<array<double>>")

    def step(self, key, rows: np.ndarray) -> pd.DataFrame:
        b, nf, hist = self.b, self.n_features, self.hist.get()
        old = np.array([list(x) for x in hist[0]] if hist else [], dtype=np.float64).reshape(-1, nf)
        allx = np.vstack([old, rows[:, 1:1 + nf]])
        idx = np.arange(len(rows)) + len(old)                  # position of each new bar
        ok = idx >= b
        out, pred = rows[ok], np.array([], dtype=np.float64)
        if ok.any():
            win = np.lib.stride_tricks.sliding_window_view(allx, b, axis=0).transpose(0, 2, 1)
            pred = L.forward(self.theta, win[idx[ok] - b]) * (out[:, -1] - out[:, -2]) + out[:, -2]
        self.hist.update((allx[-b:].tolist(),))
        return _pairs(key, out, out[:, 1 + nf], pred)


class Pairs(InOrder):
    """ST4: the previous prediction of a key beside the next bar."""

    def __init__(self, delayed: bool):
        super().__init__(["value_a", "value_p"], delayed)

    def open(self, handle) -> None:
        self.prev = handle.getValueState("prev", "predicted double")

    def step(self, key, rows: np.ndarray) -> pd.DataFrame:
        prev = self.prev.get()
        before = np.concatenate([[np.nan if prev is None or prev[0] is None else prev[0]], rows[:, 2]])
        keep = ~np.isnan(before[:-1])
        self.prev.update((None if np.isnan(before[-1]) else float(before[-1]),))
        return _pairs(key, rows[keep], rows[keep, 1], before[:-1][keep])


def score_stream(bars: DataFrame, scaler: DataFrame, theta, b: int = 4,
                 features: Sequence[str] = ("close", "volume"), delay: str | None = None) -> DataFrame:
    """ST5 (+ ST4 pairing): for each incoming bar, the prediction made from
    the ``b`` bars before it, beside the bar's close.

    ``scaler`` is a static per-symbol table (``<f>_min``/``<f>_max`` and
    ``target_min``/``target_max``) joined to the stream (J2); ``theta`` is a
    fixed parameter vector. Output: (symbol, ts, actual, predicted), the
    streaming form of ``forecast.forecast_pairs``.
    """
    th = np.asarray(theta, dtype=np.float64)
    feats = list(features)
    s = _event_time(bars, delay).join(scaler, "symbol", "inner")
    xs = [minmax_scale(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")).alias(f"x{j}") for j, c in enumerate(feats)]
    s = s.select("symbol", "ts", F.col("close").cast("double").alias("close"),
                 *xs, "target_min", "target_max")
    return _keyed(s, Scores(th, b, len(feats), delay is not None))


def emit_pairs(scored: DataFrame, actual: str = "close", predicted: str = "predicted",
               delay: str | None = None) -> DataFrame:
    """ST4: keyed state holds the previous prediction; each bar emits
    (actual of this bar, prediction made on the previous bar). The first bar
    of a symbol emits nothing."""
    s = _event_time(scored, delay).select("symbol", "ts",
                      F.col(actual).cast("double").alias("value_a"), F.col(predicted).cast("double").alias("value_p"))
    return _keyed(s, Pairs(delay is not None))


def theta_store(spark: SparkSession, path: str, **options) -> VersionedStore:
    """K5 / ST6: the newest parameters of every symbol, a version a batch."""
    schema = T.StructType.fromDDL("symbol string, version long, theta array<double>")
    return VersionedStore(spark, path, schema, 1, order="version", **options)


def retrain_writer(bars: VersionedStore, models: VersionedStore, train_fn):
    """ST6: ``foreachBatch`` function that appends the batch to the rolling
    store and retrains the symbols of the batch on what the store holds of them
    (M7), storing their parameters as version ``batch_id + 1``.

    ``train_fn(bars, init, version)`` returns (symbol, version, theta). Its
    input is the store as of this batch and the parameters as of the batch
    before, found by batch id, so a replay, after a crash between any two
    steps, trains from the same state; a batch whose parameters are stored is
    not trained again."""
    def run(batch: DataFrame, batch_id: int):
        if batch.isEmpty():
            return
        stored = bars.append(batch, batch_id)
        if models.committed(batch_id):
            return
        touched = batch.select("symbol").distinct()
        rows = bars.view(stored).join(touched, "symbol", "left_semi")
        before = models.at_batch(int(batch_id) - 1)
        init = models.view(before).select("symbol", "theta") if before["version"] else None
        models.append(train_fn(rows, init, int(batch_id) + 1), batch_id)
    return run


def refreshing_score_writer(spark: SparkSession, store_path: str, model_path: str, scaler_path: str,
                            out_path: str, b: int, features: Sequence[str]):
    """ST5 with a model refreshed between micro-batches (``foreachBatch``).

    Per batch: append the bars to the rolling store (idempotent by
    ``batch_id``), load the newest parameters (K5) and scaler of each symbol,
    build for every bar of the batch the window of the ``b`` stored bars
    before it (W2 over the bars from ``b`` before the symbol's first bar of the
    batch on, so a batch of any size is scored whole), score with the
    per-symbol parameters (M1, J2) and write (symbol, ts, actual, predicted,
    version) under ``batch_id``. A scaler table with a version column is taken
    at the version of the parameters. The state between batches is the store
    itself, so a restarted query continues from it.
    """
    from ..functions.scalar import minmax_inverse, minmax_scale
    from ..operators.features import trailing_windows
    from ..operators.lstm import lstm_fold, load_params, theta_column

    feats = list(features)

    def run(batch: DataFrame, batch_id: int):
        if batch.isEmpty():
            return
        batch.write.mode("overwrite").parquet(f"{store_path}/batch_id={int(batch_id)}")
        first = batch.groupBy("symbol").agg(F.min("ts").alias("_first"))
        known = spark.read.parquet(store_path).join(first, "symbol")
        newest = Window.partitionBy("symbol").orderBy(F.desc("ts"))
        before = (known.where(F.col("ts") < F.col("_first")).withColumn("_r", F.row_number().over(newest))
                  .where(F.col("_r") <= b).drop("_r"))
        hist = known.where(F.col("ts") >= F.col("_first")).union(before).drop("_first")
        theta = theta_column(load_params(spark, model_path))
        scaler = spark.read.parquet(scaler_path)
        if "version" in scaler.columns:
            scaler = scaler.join(theta.select("symbol", "version"), ["symbol", "version"]).drop("version")
        s = hist.join(scaler, "symbol")
        for c in feats:
            s = s.withColumn(f"{c}_s", minmax_scale(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")))
        win = trailing_windows(s, [f"{c}_s" for c in feats], b, exclude_current=True,
                               keep=["close", "target_min", "target_max"])
        win = win.join(batch.select("symbol", "ts"), ["symbol", "ts"], "left_semi")
        scored = win.join(theta, "symbol")
        h = lstm_fold(F.col("xs"), F.col("theta"), len(feats))
        out = scored.select("symbol", "ts", F.col("close").alias("actual"),
                            minmax_inverse(h, F.col("target_min"), F.col("target_max")).alias("predicted"),
                            "version")
        out.write.mode("overwrite").parquet(f"{out_path}/batch_id={int(batch_id)}")
    return run
