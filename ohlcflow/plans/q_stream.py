"""Streaming queries: each runs ``availableNow`` into a fresh folder under the
shared checkpoint directory and returns the written result table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import lstm as L
from ..schema import BAR, BAR_COLUMNS
from ..operators.series import index_series
from ..session import materialize, scratch_path
from ..sources import codec
from ..streaming import ingest as S
from ..streaming import stateful as ST
from ..streaming.supervise import Supervisor
from . import forecast
from . import training as TR
from .oracle import sql_bars_from_ticks, sql_forecast_pairs
from .q_bars import BAR_R6, H, REGISTER_LAG_SQL, hourly, stored_hourly
from .registry import register, rounded


# A closing message: a bar of no symbol, 30 days after the last one, moves the
# watermark past all bars, so that none is left held back.
PULSE = "~"


def _in_steps(rows, write, days, pulse=False):
    """Hand ``rows`` to ``write`` as a producer would over time: ``days`` days a
    step, each written after the one before."""
    lo, hi = rows.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return write(rows)
    start = dt.datetime(lo.year, lo.month, lo.day)
    while start <= hi:
        end = start + dt.timedelta(days=days)
        write(rows.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end))))
        start = end
    if pulse:
        late = F.lit(hi + dt.timedelta(days=30)).cast(rows.schema["ts"].dataType)
        write(rows.limit(1).withColumn("symbol", F.lit(PULSE)).withColumn("ts", late))


def _published(spark, sf_dir, duplicate: bool = False, days: int = 7, pulse: bool = False, bars=None):
    """Hourly bars of the driver's trades published as bus messages."""
    bars = stored_hourly(spark, sf_dir) if bars is None else bars
    if duplicate:
        bars = bars.unionByName(bars)
    path = scratch_path(spark, "bus")
    _in_steps(bars, lambda part: S.publish_messages(part, path, mode="append"), days, pulse)
    return path


def _ntz(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_ingest", f"SELECT {BAR_R6} FROM ({H})")
def q_stream_ingest(spark, sf_dir):
    """ST1 + S7 + K3 + K4: messages replayed 10 files per micro-batch,
    decoded, written by an idempotent foreachBatch sink."""
    bus = _published(spark, sf_dir)
    stream = S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=10))
    out = scratch_path(spark, "ingest")
    q, _ = S.start(stream, "ingest", spark, foreach_batch=S.idempotent_batch_writer(out))
    S.run_to_completion(q)
    return rounded(_ntz(spark.read.parquet(out).select(*BAR_COLUMNS)))


def _messages(bars):
    """Bars as bus messages (symbol, value)."""
    return codec.encode_bars_wire(bars, keep=["symbol"])


@register("stream_bus", f"SELECT {BAR_R6} FROM ({H})")
def q_stream_bus(spark, sf_dir):
    """S4 + S7: a consumer of the message log, paced by a limit a micro-batch,
    is stopped half-way, more is published, and it goes on from its checkpoint:
    every message comes once."""
    bars = stored_hourly(spark, sf_dir)
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "bus-out")
    day = F.dayofmonth("ts") % 2
    limit = max(1, bars.count() // 8)
    for k in range(2):
        S.publish_bus(_messages(bars.where(day == k)), topic)
        stream = S.decode_stream(S.bus_stream(spark, topic, limit, "replay"))
        q, _ = S.start(stream, f"bus-{k}", spark, foreach_batch=S.idempotent_batch_writer(out), processing_time="0 seconds",
                       available_now=False, out_path=topic + "-query")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return rounded(_ntz(spark.read.parquet(out).select(*BAR_COLUMNS)))


@register("stream_publish_bus", f"""SELECT b.*, count(*) OVER () AS messages, count(*) OVER () - 1 AS last_offset
  FROM (SELECT {BAR_R6} FROM ({H})) b""")
def q_stream_publish_bus(spark, sf_dir):
    """K2: a stream of bars published to the message log and read back whole,
    with the number of different offsets and the last of them."""
    path, topic = scratch_path(spark, "bars"), scratch_path(spark, "topic")
    hourly(spark, sf_dir).write.parquet(path)
    stream = S.table_stream(spark, path, max_files_per_trigger=2)
    S.run_to_completion(S.publish_bus_stream(_messages(stream), topic, "bars", scratch_path(spark, "publish")))
    got = S.bus_table(spark, topic)
    n, last = got.agg(F.countDistinct("offset"), F.max("offset")).first()
    bars = S.decode_stream(got.select("symbol", "value")).withColumns({"messages": F.lit(n).cast("bigint"), "last_offset": F.lit(last).cast("bigint")})
    return rounded(_ntz(bars.select(*BAR_COLUMNS, "messages", "last_offset")))


@register("stream_supervised", f"""SELECT {BAR_R6}, runs, outcomes FROM ({H}),
  (VALUES ('bars', 2, 'started,failed,started,finished'), ('closes', 1, 'started,finished')) AS q(query, runs, outcomes)
  WHERE query = 'bars' UNION ALL
  SELECT symbol, ts, NULL, NULL, NULL, R6(close), NULL, NULL, NULL, 1, 'started,finished' FROM ({H})""")
def q_stream_supervised(spark, sf_dir):
    """ST7: two consumers under a supervisor. The first loses its second
    micro-batch once and is restarted from its checkpoint, the other runs on;
    both results whole, with what the supervisor's table says of their runs."""
    bus = _published(spark, sf_dir)
    outs = {name: scratch_path(spark, name) for name in ("bars", "closes")}
    lost = []

    def failing(path):
        write = S.idempotent_batch_writer(path)

        def once(batch, batch_id):
            if batch_id == 1 and not lost:
                lost.append(batch_id)
                raise RuntimeError("lost micro-batch")
            write(batch, batch_id)
        return once

    def begin(name, sink):
        stream = S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=10))
        return S.start(stream, name, spark, foreach_batch=sink, out_path=outs[name] + "-query")[0]

    sup = Supervisor(spark, scratch_path(spark, "events"))
    only = [F.col(c) if c in ("symbol", "ts", "close") else F.lit(None).cast(BAR[c].dataType).alias(c) for c in BAR_COLUMNS]
    sup.run({"bars": lambda: begin("bars", failing(outs["bars"])),
             "closes": lambda: begin("closes", S.idempotent_batch_writer(outs["closes"], transform=lambda b, _: b.select(*only)))})
    told = (sup.events().groupBy("query").agg((F.max("run") + 1).alias("runs"),
                                              F.sort_array(F.collect_list(F.struct("at", "event"))).alias("e"))
            .select("query", "runs", F.array_join("e.event", ",").alias("outcomes")))
    rows = [spark.read.parquet(path).select(*BAR_COLUMNS).withColumn("query", F.lit(name)) for name, path in outs.items()]
    return rounded(_ntz(rows[0].unionByName(rows[1]).join(F.broadcast(told), "query").drop("query")))     # a row a query


@register("stream_rolling", f"""SELECT {BAR_R6} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM ({H})) WHERE rn <= 288""")
def q_stream_rolling(spark, sf_dir):
    """ST2: a micro-batch a day appended to the rolling store, which keeps the
    newest 288 bars and is compacted on the way."""
    bus = _published(spark, sf_dir)
    stream = S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=1))
    store = S.bar_store(spark, scratch_path(spark, "rolling"), TR.ROLLING_CAPACITY)
    q, _ = S.start(stream, "rolling", spark, foreach_batch=S.rolling_dataset_writer(store))
    S.run_to_completion(q)
    return rounded(_ntz(store.view()))


@register("stream_dedup", f"SELECT {BAR_R6} FROM ({H})")
def q_stream_dedup(spark, sf_dir):
    """ST3: every bar published twice; one copy per (symbol, bar time) passes."""
    bus = _published(spark, sf_dir, duplicate=True)
    stream = S.new_bars_only(S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=10)), "8 days")
    q, out = S.start(stream, "dedup", spark)
    S.run_to_completion(q)
    return rounded(_ntz(spark.read.parquet(f"{out}/data").select(*BAR_COLUMNS)))


@register("stream_resample", f"""SELECT {BAR_R6} FROM ({sql_bars_from_ticks('1 hour')})
  WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_resample(spark, sf_dir):
    """ST8: trades stream -> hourly bars, emitted when the 1-hour watermark
    closes them (the newest, still open hours are not emitted)."""
    ev = S.table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    t = ev.select(F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("seq"),
                  F.col("value").alias("price"),
                  F.get_json_object("props", "$.k").try_cast("bigint").alias("size"))
    q, out = S.start(S.resample_stream(t, "1 hour", "1 hour"), "resample", spark)
    S.run_to_completion(q)
    return rounded(_ntz(spark.read.parquet(f"{out}/data").select(*BAR_COLUMNS)))


@register("stream_forecast_pairs", sql_forecast_pairs(L.FIXED_TEST_WEIGHTS) + """
SELECT symbol, ts, R6(actual) AS actual, R6(predicted) AS predicted FROM pairs""")
def q_stream_scores(spark, sf_dir):
    """ST5: keyed state of the last 4 scaled bars scores each incoming bar
    with a static model and scaler; equals the batch flagship. Ten files of a
    day each a micro-batch, in any order within a week."""
    bars = stored_hourly(spark, sf_dir)
    scaler = forecast.series_scaler(index_series(bars))
    bus = _published(spark, sf_dir, pulse=True, bars=bars)
    stream = S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=10))
    scored = ST.score_stream(stream, scaler, L.theta_from_gates(L.FIXED_TEST_WEIGHTS), 4, delay="8 days")
    q, out = S.start(scored, "scores", spark)
    S.run_to_completion(q)
    return rounded(_ntz(spark.read.parquet(f"{out}/data")))


@register("stream_pairs", REGISTER_LAG_SQL)
def q_stream_pairs(spark, sf_dir):
    """ST4: per-bar predictions arrive as a stream; keyed state pairs each
    bar's close with the previous bar's prediction."""
    from ..functions.scalar import minmax_inverse
    from ..operators import features as X
    sc = forecast.scaled_bars(hourly(spark, sf_dir))
    win = X.trailing_windows(sc, ["close_s", "volume_s"], 4, keep=["close", "target_min", "target_max"])
    scored = win.select("symbol", "ts", "close",
                        minmax_inverse(L.lstm_fold("xs", L.FIXED_TEST_WEIGHTS, 2), F.col("target_min"),
                                       F.col("target_max")).alias("predicted"))
    topic = scratch_path(spark, "scores")
    _in_steps(materialize(scored), lambda part: part.write.mode("append").parquet(topic), 7, pulse=True)
    stream = S.table_stream(spark, topic, max_files_per_trigger=10)
    q, out = S.start(ST.emit_pairs(stream, "close", "predicted", delay="8 days"), "pairs", spark)
    S.run_to_completion(q)
    return rounded(_ntz(spark.read.parquet(f"{out}/data")))


@register("stream_retrain")
def q_stream_retrain(spark, sf_dir):
    """ST6: each micro-batch of bars retrains the symbols it touches on their
    newest 288 bars (M5, warm start from the parameters of the batch before)
    and stores a new version; the newest one of every symbol."""
    bus = _published(spark, sf_dir)
    stream = S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=15))
    bars = S.bar_store(spark, scratch_path(spark, "rolling"), TR.ROLLING_CAPACITY)
    models = ST.theta_store(spark, scratch_path(spark, "models"))

    def train(rows, init, version):
        return TR.train_symbols(rows, b=24, epochs=1, lr=0.5, init=init, version=version)

    q, _ = S.start(stream, "retrain", spark, foreach_batch=ST.retrain_writer(bars, models, train))
    S.run_to_completion(q)
    return L.thetas_to_params(models.view(), len(TR.BAR_FEATURES))


@register("stream_refresh_scores")
def q_stream_refresh(spark, sf_dir):
    """ST5 with model refresh: per micro-batch the newest stored parameters
    (trained by M5), with the scaler of the bars they were trained on, score the
    batch's bars from their previous 24 stored bars. Version 2 (warm start) is
    stored between the first and the second micro-batch."""
    from ..operators import features as X
    bars = stored_hourly(spark, sf_dir)
    models, scaler_path = scratch_path(spark, "models"), scratch_path(spark, "scaler")
    nf = len(TR.BAR_FEATURES)
    scaler = materialize(X.fit_minmax(X.lead_target(bars, "close", "target"), [*TR.BAR_FEATURES, "target"]))

    def save(version, init=None):
        scaler.write.mode("overwrite").parquet(f"{scaler_path}/version={version}")
        t = TR.train_symbols(bars, b=24, epochs=1, lr=0.5, init=init, version=version)
        L.save_params(L.thetas_to_params(t, nf), models)

    save(1)
    bus = _published(spark, sf_dir, days=1, bars=bars)
    stream = S.decode_stream(S.message_stream(spark, bus, max_files_per_trigger=10))
    store, out = scratch_path(spark, "rolling"), scratch_path(spark, "refresh-scores")
    writer = ST.refreshing_score_writer(spark, store, models, scaler_path, out, 24, TR.BAR_FEATURES)
    old = materialize(L.theta_column(L.load_params(spark, models)).select("symbol", "theta"))

    def score(batch, batch_id):
        if batch_id == 1:
            save(2, old)
        writer(batch, batch_id)

    q, _ = S.start(stream, "refresh", spark, foreach_batch=score)
    S.run_to_completion(q)
    return rounded(_ntz(spark.read.parquet(out).select("symbol", "ts", "actual", "predicted", "version")))
