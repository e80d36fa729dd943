"""Streams equal their batch twins; state carries across micro-batches."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ohlcflow.operators import lstm as L
from ohlcflow.plans import forecast
from ohlcflow.schema import BAR_COLUMNS
from ohlcflow.session import scratch_path
from ohlcflow.streaming import ingest as S
from ohlcflow.streaming import stateful as ST
from ohlcflow.streaming.store import VersionedStore


def _bars(spark, n=12, syms=("A", "B")):
    rows = []
    for s_i, s in enumerate(syms):
        for h in range(n):
            c = 10.0 + s_i + ((h * 7) % 5) * 0.3
            rows.append((s, dt.datetime(2024, 1, 1 + h // 6, h % 6), c, c + 1, c - 1, c, 100 + h * (s_i + 1), 1 + h, c))
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double, low double, "
                                       "close double, volume bigint, trade_count bigint, vwap double")




def test_g7_state_across_batches(spark, tmp_path):
    """Three one-file batches of two rows: the previous value is null only for
    the first row and is carried over batch borders."""
    src = tmp_path / "src"
    src.mkdir()
    rows = [("A", dt.datetime(2024, 1, 1, h), float(h), float(h) * 10) for h in range(6)]
    for k in range(3):
        df = spark.createDataFrame(rows[2 * k:2 * k + 2], "symbol string, ts timestamp_ntz, close double, predicted double")
        p = str(tmp_path / f"tmp{k}")
        df.coalesce(1).write.parquet(p)
        f = [x for x in os.listdir(p) if x.endswith(".parquet")][0]
        os.rename(os.path.join(p, f), str(src / f"b{k}.parquet"))
        os.utime(str(src / f"b{k}.parquet"), (1000 + k, 1000 + k))
    stream = S.table_stream(spark, str(src), max_files_per_trigger=1)
    q, out = S.start(ST.emit_pairs(stream), "g7", spark)
    S.run_to_completion(q)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = sorted((r.ts.hour, r.actual, r.predicted) for r in spark.read.parquet(f"{out}/data").collect())
    assert got == [(h, float(h), float(h - 1) * 10) for h in range(1, 6)]


def test_scoring_stream_equals_batch(spark, tmp_path):
    bars = _bars(spark, 14)
    sc = forecast.scaled_bars(bars)
    scaler = sc.select("symbol", "close_min", "close_max", "volume_min", "volume_max",
                       "target_min", "target_max").dropDuplicates(["symbol"])
    from ohlcflow.operators import features as X
    win = X.trailing_windows(sc, ["close_s", "volume_s"], 3, exclude_current=True,
                             keep=["close", "target_min", "target_max"])
    from ohlcflow.functions.scalar import minmax_inverse
    batch = win.select("symbol", "ts", F.col("close").alias("actual"),
                       minmax_inverse(L.lstm_fold("xs", L.FIXED_TEST_WEIGHTS, 2), F.col("target_min"),
                                      F.col("target_max")).alias("predicted"))
    # one file per day, replayed one file per micro-batch in time order
    src = tmp_path / "bus"
    src.mkdir()
    days = sorted({r.d for r in bars.select(F.to_date("ts").alias("d")).distinct().collect()})
    for k, d in enumerate(days):
        p = str(tmp_path / f"w{k}")
        S.publish_messages(bars.where(F.to_date("ts") == F.lit(d)).coalesce(1), p)
        for root, _, names in os.walk(p):
            for n in names:
                if n.endswith(".txt"):
                    dst = str(src / f"f{k:02d}_{n}")
                    os.rename(os.path.join(root, n), dst)
                    os.utime(dst, (2000 + k, 2000 + k))
    stream = S.decode_stream(S.message_stream(spark, str(src), max_files_per_trigger=1))
    q, out = S.start(ST.score_stream(stream, scaler, L.theta_from_gates(L.FIXED_TEST_WEIGHTS), 3), "sc", spark)
    S.run_to_completion(q)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == len(days) > 1
    got = {(r.symbol, r.ts.replace(tzinfo=None)): r.predicted for r in spark.read.parquet(f"{out}/data").collect()}
    exp = {(r.symbol, r.ts): r.predicted for r in batch.collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_dedup_and_late_bars(spark):
    bars = _bars(spark, 6, ("A",))
    path = scratch_path(spark, "dup")
    S.publish_messages(bars.unionByName(bars), path)
    stream = S.new_bars_only(S.decode_stream(S.message_stream(spark, path)), "1 hour")
    q, out = S.start(stream, "dedup", spark)
    S.run_to_completion(q)
    assert spark.read.parquet(f"{out}/data").count() == 6


def test_rolling_store_idempotent(spark):
    bars = _bars(spark, 12)
    store = S.bar_store(spark, scratch_path(spark, "roll"), 5)
    w = S.rolling_dataset_writer(store)
    w(bars, 0)
    w(bars, 0)                                     # a replayed batch is not written again
    assert store.read().count() == bars.count()
    assert store.view().groupBy("symbol").count().where("count != 5").count() == 0


def _batches(spark, n, seed=5):
    """Batches of bars, out of order, some empty of a symbol, one late."""
    rng = random.Random(seed)
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(8 * n)]
    late = ts[:3]
    out = []
    for i in range(n):
        times = ts[8 * i + 3:8 * i + 11][:8] + (late if i == n // 2 else [])
        rows = [(s, t, rng.random(), 1.0, 1.0, 1.0, 1, 1, 1.0) for t in times for s in ("A", "B") if rng.random() < 0.7]
        out.append(rows)
    return out


BAR_DDL = "symbol string, ts timestamp, open double, high double, low double, close double, volume long, trade_count long, vwap double"


def _frame(spark, rows):
    return spark.createDataFrame(rows, BAR_DDL).select(*BAR_COLUMNS)


def _newest(rows, capacity):
    out = []
    for s in {r[0] for r in rows}:
        out += sorted((r[1], round(r[2], 9), s) for r in rows if r[0] == s)[-capacity:]
    return sorted(out)


def _held(df):
    return sorted((r.ts, round(r.open, 9), r.symbol) for r in df.collect())


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", [None, "before commit", "after commit", "before compaction commit", "after compaction", "in clean"])
def test_store_survives_a_crash_at_every_step(spark, monkeypatch, step):
    """A crash in one batch, then its replay by a new writer: the view is the
    newest rows of all batches so far, after every batch."""
    root = scratch_path(spark, "crash")
    seen, batches, crashes = [], _batches(spark, 7), 0

    def store():
        return S.bar_store(spark, root, 9, max_deltas=3, keep_versions=2)

    def crash_at(kind):
        commit, clean, compact = VersionedStore._commit, VersionedStore.clean, VersionedStore.compact

        def broken_commit(self, old, **changes):
            before = kind == "before compaction commit" if "base" in changes else kind == "before commit"
            if before:
                raise Crash
            new = commit(self, old, **changes)
            if kind == "after commit" and "base" not in changes:
                raise Crash
            return new

        def broken_compact(self, old):
            new = compact(self, old)
            if kind == "after compaction":
                raise Crash
            return new

        def broken_clean(self):
            if kind == "in clean":
                raise Crash
            clean(self)
        monkeypatch.setattr(VersionedStore, "_commit", broken_commit)
        monkeypatch.setattr(VersionedStore, "compact", broken_compact)
        monkeypatch.setattr(VersionedStore, "clean", broken_clean)

    for i, rows in enumerate(batches):
        if step and i in (2, 5):                  # where deltas are due to be compacted
            crash_at(step)
            try:
                store().append(_frame(spark, rows), i)
            except Crash:
                crashes += 1
            monkeypatch.undo()
        version = store().append(_frame(spark, rows), i)
        seen += rows
        assert _held(store().view()) == _held(store().view(version)) == _newest(seen, 9), (step, i)
    assert len(store().versions()) <= 2 and (crashes > 0) == (step is not None)
    live = store()._list("data")
    again = store().append(_frame(spark, batches[-1]), 6)
    assert store()._list("data") == live and again["batch"] == 6


def test_store_reads_do_not_grow_with_its_age(spark):
    store = S.bar_store(spark, scratch_path(spark, "age"), 9, max_deltas=4)
    sizes = []
    for i, rows in enumerate(_batches(spark, 24)):
        store.append(_frame(spark, rows), i)
        sizes.append((store.size(), len(store.latest()["deltas"])))
    assert max(n for _, n in sizes) < 4 and max(s for s, _ in sizes[16:]) <= 1.2 * max(s for s, _ in sizes[4:12])
    bound = store.at_batch(22)
    before = _held(store.view(bound))
    store.append(_frame(spark, _batches(spark, 1, 9)[0]), 24)
    assert _held(store.view(bound)) == before     # a reader stays at its version
    other = S.bar_store(spark, store.root, 9)
    with pytest.raises(Exception, match="exists"):
        other._commit(store.manifest(store.latest()["version"] - 1), batch=99)
    with pytest.raises(LookupError):
        store.at_batch(3)


def test_retraining_is_the_same_after_a_replay(spark):
    """Every batch run again at every point leaves the same parameters, equal
    to a loop of warm starts over the newest bars."""
    from ohlcflow.plans import training as TR

    def train(rows, init, version):
        return TR.train_symbols(rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")), b=4, epochs=1, lr=0.3,
                                init=init, version=version)

    def run(name, replay):
        bars = S.bar_store(spark, scratch_path(spark, name), 12, max_deltas=2)
        models = ST.theta_store(spark, scratch_path(spark, name), max_deltas=2)
        calls = []

        def counted(rows, init, version):
            calls.append(version)
            if replay and version == 2 and calls.count(2) == 1:
                raise Crash                       # bars are stored, parameters are not
            return train(rows, init, version)
        write = ST.retrain_writer(bars, models, counted)
        for i, rows in enumerate(_batches(spark, 3)):
            try:
                write(_frame(spark, rows), i)
            except Crash:
                pass
            if replay:
                write(_frame(spark, rows), i)
                write(_frame(spark, rows), i)
        return {r.symbol: (r.version, r.theta) for r in models.view().collect()}, calls

    once, _ = run("once", False)
    again, calls = run("again", True)
    assert once == again and calls == [1, 2, 2, 3]

    init = None
    seen = []
    for i, rows in enumerate(_batches(spark, 3)):
        seen += rows
        newest = [r for s in ("A", "B") for r in sorted((r for r in seen if r[0] == s), key=lambda r: r[1])[-12:]]
        out = train(_frame(spark, newest), init, i + 1).collect()
        init = spark.createDataFrame([(r.symbol, r.theta) for r in out], "symbol string, theta array<double>")
    assert {r.symbol: r.theta for r in out} == {s: t for s, (_, t) in once.items()}


def test_progress_listener(spark):
    log = S.ProgressLog().attach(spark)
    bars = _bars(spark, 6, ("A",))
    path = scratch_path(spark, "lst")
    S.publish_messages(bars, path)
    q, _ = S.start(S.decode_stream(S.message_stream(spark, path)), "lst", spark)
    S.run_to_completion(q)
    deadline = time.time() + 10
    while str(q.id) not in log.progress and time.time() < deadline:
        time.sleep(0.2)
    log.detach(spark)
    assert str(q.id) in log.progress


def test_refreshing_scorer_two_batches_equal_batch(spark):
    """foreachBatch scoring with the stored model: two batches give the same
    predictions as one batch pass over the whole series."""
    import numpy as np
    from ohlcflow.operators import features as X
    from ohlcflow.functions.scalar import minmax_inverse
    bars = _bars(spark, 12).withColumn("ts", F.col("ts").cast("timestamp"))
    feats = ["close", "volume"]
    scaler = X.fit_minmax(bars, feats).withColumn("target_min", F.col("close_min")) \
        .withColumn("target_max", F.col("close_max"))
    th = L.init_theta(2, seed=4)
    models, scaler_path = scratch_path(spark, "m"), scratch_path(spark, "s")
    L.save_params(L.params_frame(spark, {"A": th, "B": th}, 2, version=1), models)
    scaler.write.parquet(scaler_path)
    store, out = scratch_path(spark, "st"), scratch_path(spark, "out")
    w = ST.refreshing_score_writer(spark, store, models, scaler_path, out, 3, feats)
    cut = F.lit("2024-01-02 00:00:00").cast("timestamp")
    w(bars.where(F.col("ts") < cut), 0)
    w(bars.where(F.col("ts") >= cut), 1)
    got = {(r.symbol, r.ts): r.predicted for r in spark.read.parquet(out).collect()}
    sc = X.apply_minmax(bars, scaler, feats, suffix="_s")
    win = X.trailing_windows(sc, ["close_s", "volume_s"], 3, exclude_current=True,
                             keep=["target_min", "target_max"])
    exp = {(r.symbol, r.ts): r.p for r in win.select(
        "symbol", "ts", minmax_inverse(L.lstm_fold("xs", L.gates_from_theta(th, 2), 2), F.col("target_min"),
                                       F.col("target_max")).alias("p")).collect()}
    assert len(exp) == 2 * (12 - 3)
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


@pytest.mark.parametrize("scoring", [False, True])
def test_out_of_order_batches_lose_nothing(spark, tmp_path, scoring):
    """Batches in the order 0, 2, 1 and a closing bar: within the delay every
    bar is paired with the bar before it in time."""
    src = tmp_path / "src"
    src.mkdir()
    rows = [("A", dt.datetime(2024, 1, 1, h), float(h + 1), float(h) * 10) for h in range(6)]
    late = [("A", dt.datetime(2024, 1, 9), 1.0, 1.0)]
    for k, part in enumerate([rows[0:2], rows[4:6], rows[2:4], late]):
        df = spark.createDataFrame(part, "symbol string, ts timestamp_ntz, close double, predicted double")
        p = str(tmp_path / f"tmp{k}")
        df.coalesce(1).write.parquet(p)
        f = [x for x in os.listdir(p) if x.endswith(".parquet")][0]
        os.rename(os.path.join(p, f), str(src / f"b{k}.parquet"))
        os.utime(str(src / f"b{k}.parquet"), (1000 + k, 1000 + k))
    stream = S.table_stream(spark, str(src), max_files_per_trigger=1)
    if scoring:
        scaler = spark.createDataFrame([("A", 0.0, 10.0, 0.0, 10.0)],
                                       "symbol string, close_min double, close_max double, target_min double, target_max double")
        th = L.init_theta(1, seed=3)
        out_stream = ST.score_stream(stream, scaler, th, 2, ["close"], delay="1 day")
    else:
        out_stream = ST.emit_pairs(stream, delay="1 day")
    q, out = S.start(out_stream, "ooo", spark)
    S.run_to_completion(q)
    got = sorted((r.ts.hour, r.actual, r.predicted) for r in spark.read.parquet(f"{out}/data").collect()
                 if r.ts.day == 1)
    if scoring:
        import numpy as np
        x = np.array([[r[2] / 10.0] for r in rows])
        want = [(h, float(h + 1), float(L.forward(th, x[None, h - 2:h])[0] * 10.0)) for h in range(2, 6)]
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(got, want))
    else:
        assert got == [(h, float(h + 1), float(h - 1) * 10) for h in range(1, 6)]


def test_refreshing_scorer_takes_any_batch_size(spark):
    """400 bars of one symbol in one batch: each with a full window is scored."""
    n = 400
    rows = [("A", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(10 + h % 7)) for h in range(n)]
    bars = spark.createDataFrame(rows, "symbol string, ts timestamp, close double")
    models, scaler_path = scratch_path(spark, "m"), scratch_path(spark, "s")
    frame = L.params_frame(spark, {"A": L.init_theta(1, seed=4)}, 1, version=1)
    L.save_params(frame, models)
    L.save_params(frame, models)                   # a replayed batch replaces itself
    assert L.load_params(spark, models).count() == 4
    spark.createDataFrame([("A", 10.0, 16.0, 10.0, 16.0)], "symbol string, close_min double, close_max double, "
                          "target_min double, target_max double").write.parquet(scaler_path)
    out = scratch_path(spark, "out")
    ST.refreshing_score_writer(spark, scratch_path(spark, "st"), models, scaler_path, out, 3, ["close"])(bars, 0)
    assert spark.read.parquet(out).count() == n - 3


def test_refresh_query_sees_two_versions_and_the_training_scaler(spark, monkeypatch):
    from ohlcflow.plans import q_stream
    paths, writer = [], ST.refreshing_score_writer
    monkeypatch.setattr(ST, "refreshing_score_writer", lambda *a: paths.append(a[3]) or writer(*a))
    got = q_stream.q_stream_refresh(spark, "/root/testdata/sf0.001")
    assert {r.version for r in got.select("version").distinct().collect()} == {1, 2}
    assert got.count() == got.select("symbol", "ts").distinct().count()
    want = {r.symbol: (r.lo, r.hi) for r in q_stream.stored_hourly(spark, "/root/testdata/sf0.001").groupBy("symbol").agg(
        F.min("close").alias("lo"), F.max("close").alias("hi")).collect()}
    assert {r.symbol: (r.close_min, r.close_max) for r in spark.read.parquet(paths[0]).collect()} == want
