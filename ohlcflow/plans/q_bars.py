"""Bar, feature and split queries over the driver tables (S*, P*, U*, L*, D*,
A*, W*, J*, F*, M8, M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables
from ..functions.scalar import minmax_inverse, reshape_steps, sigmoid, dot
from ..operators import bars as B
from ..operators import features as X
from ..operators.lstm import FIXED_TEST_WEIGHTS, load_params, lstm_fold, save_params
from ..schema import BAR, BAR_COLUMNS
from ..session import materialize, scratch_path
from ..sources import codec, files
from ..streaming.ingest import idempotent_batch_writer
from ..streaming.series_index import SeriesIndex
from . import forecast
from .oracle import sql_bars_from_ticks, sql_lstm_step, sql_resample
from .registry import register, rounded

H = sql_bars_from_ticks("1 hour")
D = sql_bars_from_ticks("1 day", tables.SQL_DAILY_ROWS)
BAR_R6 = ("symbol, ts, R6(open) AS open, R6(high) AS high, R6(low) AS low, R6(close) AS close, "
          "volume, trade_count, R6(vwap) AS vwap")
SCALE_COLS = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]


def hourly(spark, sf_dir):
    return B.ticks_to_bars(tables.ticks(spark, sf_dir), "1 hour")


def daily(spark, sf_dir):
    return B.ticks_to_bars(tables.daily_rows(spark, sf_dir), "1 day")


def stored_hourly(spark, sf_dir):
    """Hourly bars written once, for plans that read them more than once (row
    numbering counts them first), so that the trades are scanned once."""
    return materialize(hourly(spark, sf_dir))


def stored_daily(spark, sf_dir):
    return materialize(daily(spark, sf_dir))


def ntz(df, col="ts"):
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


# ---------------------------------------------------------------- R1 / S*

@register("bars_15m", f"SELECT {BAR_R6} FROM ({sql_bars_from_ticks('15 minutes')})")
def q_bars_15m(spark, sf_dir):
    return rounded(B.ticks_to_bars(tables.ticks(spark, sf_dir), "15 minutes"))


@register("bars_daily_from_hourly", f"SELECT {BAR_R6} FROM ({sql_resample('1 day', H)})")
def q_bars_daily(spark, sf_dir):
    return rounded(B.resample_bars(hourly(spark, sf_dir), "1 day"))


@register("bars_codec_roundtrip", f"SELECT {BAR_R6} FROM ({H})")
def q_codec(spark, sf_dir):
    """K2 encode with quoted numbers -> S4 decode -> S5 flatten."""
    wire = codec.encode_bars_wire(hourly(spark, sf_dir), quote_numbers=True, keep=["symbol"])
    dec = wire.select("symbol", codec.decode_bar_struct(F.col("value")).alias("pdata"))
    return rounded(ntz(codec.flatten_bar(dec, "pdata", F.col("symbol"))))


@register("frames_decode", f"SELECT {BAR_R6} FROM ({H})")
def q_frames(spark, sf_dir):
    """Frames of two messages (a bar and a non-bar) -> bars only."""
    h = hourly(spark, sf_dir)
    frames = h.select(F.to_json(F.array(codec.bar_message(h, "b"), codec.bar_message(h, "q"))).alias("value"))
    return rounded(ntz(codec.decode_frames(frames)))


@register("bars_between", f"""SELECT {BAR_R6} FROM ({sql_resample('1 day', f"SELECT * FROM ({H}) WHERE symbol = 'click' AND ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'")})""")
def q_between(spark, sf_dir):
    # The bounds are aligned with the bar width, so they hold for trades, too,
    # and reach the scan (PushedFilters) there.
    start, end = "2024-01-08 00:00:00", "2024-01-15 00:00:00"
    ticks = tables.ticks(spark, sf_dir).where((F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
                                              & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
    return rounded(B.bars_between(B.ticks_to_bars(ticks, "1 hour"), "click", start, end, "1 day"))


@register("ticks_typed", f"SELECT symbol, ts, seq, R6(price) AS price, size FROM ({tables.SQL_TICKS})")
def q_ticks(spark, sf_dir):
    return rounded(tables.ticks(spark, sf_dir))


# ---------------------------------------------------------------- L / U / P

@register("latest_bar", f"""SELECT {BAR_R6} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM ({H})) WHERE rn = 1""")
def q_latest(spark, sf_dir):
    return rounded(B.latest_bar(hourly(spark, sf_dir)))


@register("rolling_retention", f"""SELECT {BAR_R6} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM ({H})) WHERE rn <= 288""")
def q_retention(spark, sf_dir):
    return rounded(B.rolling_retention(stored_hourly(spark, sf_dir), 288))


@register("head_bars", f"SELECT {BAR_R6} FROM ({H}) ORDER BY ts, symbol LIMIT 100")
def q_head(spark, sf_dir):
    return rounded(B.head(hourly(spark, sf_dir), 100))


@register("new_bars_only", f"""SELECT {BAR_R6} FROM (
  SELECT h.* FROM ({H}) h LEFT JOIN (
    SELECT symbol, max(ts) AS seen_ts FROM ({H}) WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY symbol) s
  ON h.symbol = s.symbol WHERE s.seen_ts IS NULL OR h.ts > s.seen_ts)""")
def q_new_bars(spark, sf_dir):
    h = stored_hourly(spark, sf_dir)
    seen = h.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return rounded(B.newer_than_seen(h, seen))


@register("bars_union", f"SELECT {BAR_R6} FROM ({H})")
def q_union(spark, sf_dir):
    t = tables.ticks(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    stored = B.ticks_to_bars(t.where(F.col("ts") < cut), "1 hour")
    new = B.ticks_to_bars(t.where(F.col("ts") >= cut), "1 hour")
    return rounded(B.append_bars(stored, new))


@register("daily_open_column", f"SELECT R6(open) AS open FROM ({D})")
def q_column_at(spark, sf_dir):
    return rounded(B.column_at(daily(spark, sf_dir), 2))


@register("bar_counts", f"""SELECT symbol, count(*) AS bars, CAST(sum(trade_count) AS BIGINT) AS trades,
  CAST(sum(volume) AS BIGINT) AS volume FROM ({H}) GROUP BY symbol""")
def q_counts(spark, sf_dir):
    return (hourly(spark, sf_dir).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("bars"), F.sum("trade_count").alias("trades"),
                 F.sum("volume").alias("volume")))


@register("label_counts", "SELECT lang AS label, count(*) AS count FROM documents "
          "WHERE lang IS NOT NULL GROUP BY lang ORDER BY count DESC, label")
def q_label_counts(spark, sf_dir):
    d = tables.documents(spark, sf_dir)
    return (d.where(F.col("label").isNotNull()).groupBy("label").count()
            .orderBy(F.desc("count"), "label"))


@register("label_index", "SELECT doc_id, lang AS label, "
          "CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_index FROM documents")
def q_label_index(spark, sf_dir):
    d = tables.documents(spark, sf_dir).select("doc_id", "label")
    out, _ = B.label_index(d)
    return out


# ---------------------------------------------------------------- D splits

@register("chronological_split", f"""SELECT symbol, ts,
  CASE WHEN rn > n - CAST(ceil(0.2 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT symbol, ts, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn,
               count(*) OVER (PARTITION BY symbol) AS n FROM ({H}))""")
def q_chrono(spark, sf_dir):
    return B.chronological_split(stored_hourly(spark, sf_dir)).select("symbol", "ts", "split")


def _stored_index(spark, sf_dir):
    """Hourly bars as a growing series: a batch a week with the weeks out of
    order, a tenth of all bars late in a last batch over all weeks."""
    bars = stored_hourly(spark, sf_dir).withColumn("_week", F.date_trunc("week", "ts"))
    late = F.pmod(F.xxhash64("symbol", "ts"), F.lit(10)) == 0
    weeks = [r[0] for r in bars.select("_week").distinct().orderBy("_week").collect()]
    index = SeriesIndex(spark, scratch_path(spark, "series-index"), BAR)
    for k, week in enumerate([*weeks[::2], *weeks[1::2]]):
        index.append(bars.where((F.col("_week") == F.lit(week)) & ~late), k)
    index.append(bars.where(late), len(weeks))
    return index


@register("series_index", f"""SELECT {BAR_R6}, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS position,
  count(*) OVER (PARTITION BY symbol) AS bars FROM ({H})""")
def q_series_index(spark, sf_dir):
    """Positions of all bars from the index kept by deltas."""
    rows = _stored_index(spark, sf_dir).read()
    return rounded(ntz(rows.withColumnsRenamed({"_g": "position", "_n": "bars"})))


@register("series_index_newest", f"""SELECT {BAR_R6} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS rn FROM ({H})) WHERE rn <= 288""")
def q_series_newest(spark, sf_dir):
    """L2 from the stored index: only the last days are read."""
    return rounded(ntz(_stored_index(spark, sf_dir).newest(288).drop("_g", "_n")))


@register("random_split", """SELECT doc_id, bucket, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split
  FROM (SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '1234'), 1, 8))::BIGINT % 100 AS INTEGER)
        AS bucket FROM documents)""")
def q_random_split(spark, sf_dir):
    d = tables.documents(spark, sf_dir).select("doc_id")
    return B.random_split(d, "doc_id").select("doc_id", B.hash_bucket("doc_id").alias("bucket"), "split")


@register("tail_with_context", f"""SELECT symbol, ts, split, R6(close) AS close FROM (
  SELECT symbol, ts, close, rn, n, CAST(ceil(0.2 * n) AS BIGINT) AS nt,
         CASE WHEN rn > n - CAST(ceil(0.2 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn,
               count(*) OVER (PARTITION BY symbol) AS n FROM ({D})))
  WHERE rn > n - nt - 60""")
def q_tail(spark, sf_dir):
    """D1 split, U2 re-concatenation with a split tag, L3 test + 60 context rows."""
    sp = B.chronological_split(stored_daily(spark, sf_dir), bucket="year", keep_index=True)
    train = sp.where(F.col("split") == "train").drop("split")
    test = sp.where(F.col("split") == "test").drop("split")
    tagged = B.concat_tagged(train, test)
    return rounded(B.tail_with_context(tagged, 60).select("symbol", "ts", "split", "close"))


# ---------------------------------------------------------------- A1 / F*

def _minmax_sql(cols):
    parts = [f"SELECT symbol, '{c}' AS feature, R6(CAST(min({c}) AS DOUBLE)) AS min_value, "
             f"R6(CAST(max({c}) AS DOUBLE)) AS max_value FROM ({H}) GROUP BY symbol" for c in cols]
    return " UNION ALL ".join(parts)


@register("minmax_fit", _minmax_sql(SCALE_COLS))
def q_minmax_fit(spark, sf_dir):
    return rounded(X.fit_minmax_long(hourly(spark, sf_dir), SCALE_COLS))


def _scaled_sql(cols):
    aggs = ", ".join(f"CAST(min({c}) AS DOUBLE) AS {c}_min, CAST(max({c}) AS DOUBLE) AS {c}_max" for c in cols)
    exprs = ", ".join(f"R6(CASE WHEN {c}_max = {c}_min THEN 0.0 ELSE ({c} - {c}_min) / ({c}_max - {c}_min) END) AS {c}_s"
                      for c in cols)
    return f"SELECT symbol, ts, {exprs} FROM ({H}) h JOIN (SELECT symbol, {aggs} FROM ({H}) GROUP BY symbol) s USING (symbol)"


@register("minmax_scaled", _scaled_sql(SCALE_COLS))
def q_minmax_scaled(spark, sf_dir):
    h = stored_hourly(spark, sf_dir)
    out = X.apply_minmax(h, X.fit_minmax(h, SCALE_COLS), SCALE_COLS, suffix="_s")
    return rounded(out.select("symbol", "ts", *[f"{c}_s" for c in SCALE_COLS]))


@register("cell_functions", f"""SELECT symbol, ts,
  R6(1.0 / (1.0 + exp(-(close_s + 1e-12)))) AS sig, R6(tanh(close_s)) AS th,
  R6(pow(close_s - volume_s, 2)) AS sq, R6(close_s * 0.45 + volume_s * 0.25) AS dot,
  R6(ROUND(close_s * (close_max - close_min) + close_min, 3)) AS close_back
  FROM (SELECT h.symbol, h.ts, s.close_min, s.close_max,
        CASE WHEN close_max = close_min THEN 0.0 ELSE (close - close_min) / (close_max - close_min) END AS close_s,
        CASE WHEN volume_max = volume_min THEN 0.0 ELSE (volume - volume_min) / (volume_max - volume_min) END AS volume_s
        FROM ({H}) h JOIN (SELECT symbol, CAST(min(close) AS DOUBLE) AS close_min, CAST(max(close) AS DOUBLE) AS close_max,
                            CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max
                           FROM ({H}) GROUP BY symbol) s ON h.symbol = s.symbol)""")
def q_cell_functions(spark, sf_dir):
    h = stored_hourly(spark, sf_dir)
    s = X.apply_minmax(h, X.fit_minmax(h, ["close", "volume"]), ["close", "volume"], suffix="_s")
    c, v = F.col("close_s"), F.col("volume_s")
    return rounded(s.select("symbol", "ts", sigmoid(c).alias("sig"), F.tanh(c).alias("th"),
                            F.pow(c - v, 2).alias("sq"), dot([c, v], [0.45, 0.25]).alias("dot"),
                            F.round(minmax_inverse(c, F.col("close_min"), F.col("close_max")), 3).alias("close_back")))


# ---------------------------------------------------------------- W1-W4 / J*

LEAD_SQL = f"""SELECT symbol, ts, close, volume, coalesce(t, avg(t) OVER (PARTITION BY symbol)) AS target,
         g, n FROM (SELECT *, lead(close) OVER w AS t, row_number() OVER w - 1 AS g,
                    count(*) OVER (PARTITION BY symbol) AS n FROM ({H})
                    WINDOW w AS (PARTITION BY symbol ORDER BY ts))"""


@register("lead_target", f"SELECT symbol, ts, R6(close) AS close, R6(target) AS target FROM ({LEAD_SQL})")
def q_lead(spark, sf_dir):
    return rounded(X.lead_target(stored_hourly(spark, sf_dir)).select("symbol", "ts", "close", "target"))


@register("sequence_windows", f"""WITH lt AS ({LEAD_SQL})
  SELECT a.symbol, a.g AS win_id, r.g - a.g AS pos, R6(r.close) AS close,
         R6(CAST(r.volume AS DOUBLE)) AS volume, R6(r.target) AS target
  FROM lt a JOIN lt r ON r.symbol = a.symbol AND r.g BETWEEN a.g AND a.g + 3 WHERE a.g + 4 < a.n""")
def q_windows(spark, sf_dir):
    lt = X.lead_target(stored_hourly(spark, sf_dir), keep_index=True)
    w = X.sequence_windows(lt, ["close", "volume"], 4, target="target")
    e = w.select("symbol", "win_id", F.posexplode("xs").alias("pos", "x"), "ys")
    return rounded(e.select("symbol", "win_id", F.col("pos").cast("bigint").alias("pos"),
                            F.col("x")[0].alias("close"), F.col("x")[1].alias("volume"),
                            F.col("ys")[F.col("pos")].alias("target")))


@register("lag_features", f"""SELECT symbol, ts, y, n_lags, x_first, x_last, x_min, x_max FROM (
  SELECT symbol, ts, R6(close) AS y, 60 AS n_lags,
         R6(lag(close, 60) OVER w) AS x_first, R6(lag(close, 1) OVER w) AS x_last,
         R6(min(close) OVER (w ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)) AS x_min,
         R6(max(close) OVER (w ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)) AS x_max,
         row_number() OVER w - 1 AS g
  FROM ({D}) WINDOW w AS (PARTITION BY symbol ORDER BY ts)) WHERE g >= 60""")
def q_lags(spark, sf_dir):
    lf = X.lag_features(stored_daily(spark, sf_dir), "close", 60, bucket="year")
    return rounded(lf.select("symbol", "ts", "y", F.size("xs").alias("n_lags"),
                             F.col("xs")[0].alias("x_first"), F.col("xs")[59].alias("x_last"),
                             F.array_min("xs").alias("x_min"), F.array_max("xs").alias("x_max")))


@register("align_xy", f"""SELECT f.symbol, f.ts, R6(f.close_s) AS close_s, R6(f.volume_s) AS volume_s, R6(t.target) AS target
  FROM (SELECT symbol, ts,
        CASE WHEN close_max = close_min THEN 0.0 ELSE (close - close_min) / (close_max - close_min) END AS close_s,
        CASE WHEN volume_max = volume_min THEN 0.0 ELSE (volume - volume_min) / (volume_max - volume_min) END AS volume_s
        FROM ({H}) h JOIN (SELECT symbol, CAST(min(close) AS DOUBLE) AS close_min, CAST(max(close) AS DOUBLE) AS close_max,
                           CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max
                           FROM ({H}) GROUP BY symbol) s USING (symbol)) f
  JOIN ({LEAD_SQL}) t ON f.symbol = t.symbol AND f.ts = t.ts""")
def q_align(spark, sf_dir):
    h = stored_hourly(spark, sf_dir)
    feats = X.apply_minmax(h, X.fit_minmax(h, ["close", "volume"]), ["close", "volume"], suffix="_s") \
        .select("symbol", "ts", "close_s", "volume_s")
    targ = X.lead_target(h).select("symbol", "ts", "target")
    return rounded(X.align_xy(feats, targ))


SPLIT_SQL = f"""SELECT symbol, ts, close, volume,
    CASE WHEN rn > n - CAST(ceil(0.2 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn,
        count(*) OVER (PARTITION BY symbol) AS n FROM ({H}))"""


@register("scaled_with_train_fit", f"""SELECT p.symbol, p.ts, p.split,
  R6(CASE WHEN close_max = close_min THEN 0.0 ELSE (close - close_min) / (close_max - close_min) END) AS close_s,
  R6(CASE WHEN volume_max = volume_min THEN 0.0 ELSE (volume - volume_min) / (volume_max - volume_min) END) AS volume_s
  FROM ({SPLIT_SQL}) p JOIN (SELECT symbol, CAST(min(close) AS DOUBLE) AS close_min, CAST(max(close) AS DOUBLE) AS close_max,
        CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max
        FROM ({SPLIT_SQL}) WHERE split = 'train' GROUP BY symbol) s ON p.symbol = s.symbol""")
def q_train_fit(spark, sf_dir):
    sp = B.chronological_split(stored_hourly(spark, sf_dir))
    fit = X.fit_minmax(sp.where(F.col("split") == "train"), ["close", "volume"])
    out = X.apply_minmax(sp, fit, ["close", "volume"], suffix="_s")
    return rounded(out.select("symbol", "ts", "split", "close_s", "volume_s"))


# ---------------------------------------------------------------- W4 / J3 / M8 / M9

def _fold_sql(seed_where: str, b: int = 4) -> str:
    h2, c2 = sql_lstm_step(FIXED_TEST_WEIGHTS, ["x.x0", "x.x1"], "r.h", "r.c")
    return f"""rec(symbol, t, s, h, c) AS (
  SELECT symbol, g, 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM x WHERE {seed_where}
  UNION ALL
  SELECT r.symbol, r.t, r.s + 1, {h2}, {c2}
  FROM rec r JOIN x ON x.symbol = r.symbol AND x.g = r.t - {b - 1} + r.s WHERE r.s < {b})"""


SCALED_X = f"""idx AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS g,
                      count(*) OVER (PARTITION BY symbol) AS n FROM ({H})),
sc AS (SELECT symbol, CAST(min(close) AS DOUBLE) AS close_min, CAST(max(close) AS DOUBLE) AS close_max,
              CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max,
              min(close) FILTER (WHERE g >= 1) AS target_min, max(close) FILTER (WHERE g >= 1) AS target_max
       FROM idx GROUP BY symbol),
x AS (SELECT i.symbol, i.ts, i.g, i.n, i.close, sc.target_min, sc.target_max,
             CASE WHEN close_max = close_min THEN 0.0 ELSE (i.close - close_min) / (close_max - close_min) END AS x0,
             CASE WHEN volume_max = volume_min THEN 0.0 ELSE (i.volume - volume_min) / (volume_max - volume_min) END AS x1
      FROM idx i JOIN sc USING (symbol))"""


# lag_prediction's oracle: score each bar from the window ending at it, then
# pair with the next bar.
REGISTER_LAG_SQL = f"""WITH RECURSIVE {SCALED_X}, {_fold_sql('g >= 3')},
pred AS (SELECT r.symbol, r.t, r.h * (x.target_max - x.target_min) + x.target_min AS predicted
         FROM rec r JOIN x ON x.symbol = r.symbol AND x.g = r.t WHERE r.s = 4)
SELECT x.symbol, x.ts, R6(x.close) AS actual, R6(p.predicted) AS predicted
FROM x JOIN pred p ON p.symbol = x.symbol AND p.t = x.g - 1"""


@register("lag_prediction", REGISTER_LAG_SQL)
def q_lag_prediction(spark, sf_dir):
    """W4 + J3 on per-bar scores (window ending at the bar), then lag."""
    sc = forecast.scaled_bars(hourly(spark, sf_dir))
    win = X.trailing_windows(sc, ["close_s", "volume_s"], 4, keep=["close", "target_min", "target_max"])
    scored = win.select("symbol", "ts", "close", minmax_inverse(lstm_fold("xs", FIXED_TEST_WEIGHTS, 2),
                                                                F.col("target_min"), F.col("target_max")).alias("predicted"))
    return rounded(X.pair_actual_predicted(scored, "close", "predicted"))


@register("predict_next", f"""WITH RECURSIVE {SCALED_X}, {_fold_sql('g = n - 1')}
SELECT x.symbol, x.ts, R6(x.close) AS current, R6(ROUND(r.h * (x.target_max - x.target_min) + x.target_min, 3)) AS predicted
FROM rec r JOIN x ON x.symbol = r.symbol AND x.g = r.t WHERE r.s = 4""")
def q_predict_next(spark, sf_dir):
    """M8: score the newest window (last 4 bars) of each symbol."""
    sc = forecast.scaled_bars(hourly(spark, sf_dir))
    last = sc.where(F.col("_g") >= F.col("_n") - F.lit(4))
    g = (last.groupBy("symbol")
         .agg(F.array_sort(F.collect_list(F.struct("_g", F.array("close_s", "volume_s").alias("x")))).alias("w"),
              F.max_by(F.struct("ts", "close", "target_min", "target_max"), "_g").alias("last"))
         .where(F.size("w") == 4))
    xs = F.transform("w", lambda s: s["x"])
    pred = F.round(minmax_inverse(lstm_fold(xs, FIXED_TEST_WEIGHTS, 2), F.col("last.target_min"),
                                  F.col("last.target_max")), 3)
    return rounded(g.select("symbol", F.col("last.ts").alias("ts"), F.col("last.close").alias("current"),
                            pred.alias("predicted")))


def validation_report(spark, sf_dir, b: int = 4):
    """M9 / K7: scaler fitted on the train split, windows inside the test
    split, each test bar beside its next close and its prediction."""
    # one row numbering serves the lead, the split and the windows
    lt = X.lead_target(stored_hourly(spark, sf_dir), keep_index=True)
    sp = B.chronological_split(lt, keep_index=True)
    fit = X.fit_minmax(sp.where(F.col("split") == "train"), ["close", "volume", "target"])
    scaled = X.apply_minmax(sp, fit, ["close", "volume"], suffix="_s")
    win = X.trailing_windows(scaled, ["close_s", "volume_s"], b,
                             keep=["close", "target", "target_min", "target_max", "_n"])
    n_train = F.col("_n") - F.ceil(F.col("_n") * F.lit(0.2))
    win = win.where(F.col("pos") - F.lit(b - 1) >= n_train)
    h = lstm_fold("xs", FIXED_TEST_WEIGHTS, 2)
    return win.select("symbol", "ts", F.round("close", 3).alias("current"), F.round("target", 3).alias("target"),
                      F.round(minmax_inverse(h, F.col("target_min"), F.col("target_max")), 3).alias("predicted"))


VALID_SQL = f"""WITH RECURSIVE
lt AS ({LEAD_SQL}),
sp AS (SELECT *, n - CAST(ceil(0.2 * n) AS BIGINT) AS n_train FROM lt),
sc AS (SELECT symbol, CAST(min(close) AS DOUBLE) AS close_min, CAST(max(close) AS DOUBLE) AS close_max,
              CAST(min(volume) AS DOUBLE) AS volume_min, CAST(max(volume) AS DOUBLE) AS volume_max,
              min(target) AS target_min, max(target) AS target_max
       FROM sp WHERE g < n_train GROUP BY symbol),
x AS (SELECT sp.symbol, sp.ts, sp.g, sp.n_train, sp.close, sp.target, sc.target_min, sc.target_max,
             CASE WHEN close_max = close_min THEN 0.0 ELSE (sp.close - close_min) / (close_max - close_min) END AS x0,
             CASE WHEN volume_max = volume_min THEN 0.0 ELSE (sp.volume - volume_min) / (volume_max - volume_min) END AS x1
      FROM sp JOIN sc USING (symbol)),
{_fold_sql('g - 3 >= n_train')},
report AS (SELECT x.symbol, x.ts, ROUND(x.close, 3) AS current, ROUND(x.target, 3) AS target,
                  ROUND(r.h * (x.target_max - x.target_min) + x.target_min, 3) AS predicted
           FROM rec r JOIN x ON x.symbol = r.symbol AND x.g = r.t WHERE r.s = 4)"""


@register("validation_report", VALID_SQL + "\nSELECT symbol, ts, R6(current) AS current, R6(target) AS target, "
          "R6(predicted) AS predicted FROM report")
def q_validation(spark, sf_dir):
    return rounded(validation_report(spark, sf_dir))


@register("validation_error", VALID_SQL + """
SELECT symbol, count(*) AS pairs, R6(avg(abs(target - predicted))) AS mae,
       R6(sqrt(avg((target - predicted) * (target - predicted)))) AS rmse,
       R6(avg((target - predicted) * (target - predicted) / 2.0)) AS loss FROM report GROUP BY symbol""")
def q_validation_error(spark, sf_dir):
    return rounded(forecast.error_metrics(validation_report(spark, sf_dir), "target", "predicted"))


# ---------------------------------------------------------------- S1-S3, K1 file round trips

@register("bars_csv_roundtrip", f"SELECT {BAR_R6} FROM ({H})")
def q_csv_roundtrip(spark, sf_dir):
    """K1 writes hourly bars as headered CSV per symbol, S1 reads them back."""
    path = scratch_path(spark, "bars-csv")
    files.write_bars_csv(hourly(spark, sf_dir), path, by_symbol=True)
    return rounded(ntz(files.read_bars_csv(spark, path)))


@register("bars_json_roundtrip", f"SELECT {BAR_R6} FROM ({H})")
def q_json_roundtrip(spark, sf_dir):
    """Bars as JSON lines with quoted numbers, read back by S3."""
    path = scratch_path(spark, "bars-json")
    files.write_bars_json(hourly(spark, sf_dir), path)
    return rounded(ntz(files.read_bars_json(spark, path)))


@register("daily_csv_roundtrip", f"""SELECT symbol, CAST(ts AS DATE) AS date, R6(open) AS open, R6(high) AS high,
  R6(low) AS low, R6(close) AS close, volume FROM ({D})""")
def q_daily_csv(spark, sf_dir):
    """Daily bars written as M/d/yyyy dates and grouped volumes, read by S2."""
    path = scratch_path(spark, "daily-csv")
    files.write_daily_csv(daily(spark, sf_dir), path)
    return rounded(files.read_daily_csv(spark, path))


@register("report_roundtrip", VALID_SQL + "\nSELECT symbol, ts, R6(current) AS current, R6(target) AS target, "
          "R6(predicted) AS predicted FROM report")
def q_report(spark, sf_dir):
    """K7: the validation report written as headered CSV and read back."""
    path = scratch_path(spark, "report")
    report = validation_report(spark, sf_dir)
    files.write_report(report, path, "csv")
    return rounded(spark.read.option("header", True).schema(report.schema).csv(path))


@register("labelled_csv_roundtrip", "SELECT doc_id, lang AS label, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def q_labelled_csv(spark, sf_dir):
    """The documents as a headered CSV of many-line texts, read back."""
    path = scratch_path(spark, "labelled-csv")
    docs = tables.documents(spark, sf_dir).withColumnRenamed("label", "author")
    files.write_labelled_csv(docs, path)
    back = files.read_labelled_csv(spark, path, id_col="doc_id")
    return back.select("doc_id", "label", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"))


# ---------------------------------------------------------------- P1, P2, P4, J2

@register("bars_projected", f"SELECT symbol, ts, R6(close) AS last, volume AS shares FROM ({H})")
def q_projected(spark, sf_dir):
    """P2 drops the columns that are not needed, P1 renames the rest."""
    kept = B.drop_columns(hourly(spark, sf_dir), "open", "high", "low", "trade_count", "vwap")
    return rounded(B.project(kept, {"symbol": "symbol", "ts": "ts", "last": "close", "shares": "volume"}))


@register("bar_schema", "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{f.name}' AS name, '{f.dataType.simpleString() if f.name != 'ts' else 'timestamp_ntz'}' AS type, "
    f"count({f.name}) AS filled FROM ({H})" for i, f in enumerate(BAR.fields)))
def q_schema(spark, sf_dir):
    """The columns of the hourly bars, their types and how many are filled."""
    bars = hourly(spark, sf_dir).select(*BAR_COLUMNS)
    listed = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), F.lit(kind).alias("type"),
                       F.count(name).alias("filled")) for i, (name, kind) in enumerate(B.schema_listing(bars))]
    return bars.agg(F.array(*listed).alias("c")).select(F.inline("c"))


@register("lag_steps", f"""SELECT symbol, ts, CAST(k - 1 AS BIGINT) AS step, R6(list_extract(xs, k)) AS close FROM (
  SELECT symbol, ts, unnest(range(1, 61)) AS k, xs FROM (
    SELECT symbol, ts, list(close) OVER (w ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS xs, row_number() OVER w - 1 AS g
    FROM ({D}) WINDOW w AS (PARTITION BY symbol ORDER BY ts)) WHERE g >= 60)""")
def q_lag_steps(spark, sf_dir):
    """60 lags as 60 steps of one feature each."""
    lf = X.lag_features(stored_daily(spark, sf_dir), "close", 60, bucket="year")
    steps = lf.select("symbol", "ts", F.posexplode(reshape_steps(F.col("xs"))).alias("step", "x"))
    return rounded(steps.select("symbol", "ts", F.col("step").cast("bigint").alias("step"), F.col("x")[0].alias("close")))


@register("batches_written", f"""SELECT {BAR_R6}, CAST(1 + (CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM ({H}))) // 7 AS BIGINT)
  AS batch FROM ({H})""")
def q_batches(spark, sf_dir):
    """Batches of a week, from the week before the first bar to the last
    one, go to a sink that an empty batch leaves alone."""
    path = scratch_path(spark, "batches")
    write = idempotent_batch_writer(path)
    bars = stored_hourly(spark, sf_dir).withColumn("day", F.to_date("ts"))
    first, last = bars.agg(F.min("day"), F.max("day")).first()
    weeks = (last - first).days // 7 + 1 if first else 0
    week = F.date_diff("day", F.lit(first)) / 7
    for k in range(weeks + 1):
        write(bars.where((week >= k - 1) & (week < k)).drop("day"), k)
    out = spark.read.parquet(path) if weeks else bars.drop("day").withColumn("batch_id", F.lit(0))
    return rounded(out.withColumn("batch", F.col("batch_id").cast("bigint")).drop("batch_id"))


@register("stored_params_beside_bars", f"""WITH sp AS ({SPLIT_SQL})
SELECT h.symbol, h.ts, CAST(CASE WHEN h.symbol = 'click' THEN 1 ELSE 2 END AS BIGINT) AS version,
  R6(CASE WHEN h.symbol = 'click' THEN t.lo ELSE a.lo END) AS close_min,
  R6(CASE WHEN h.symbol = 'click' THEN t.hi ELSE a.hi END) AS close_max
FROM sp h JOIN (SELECT symbol, min(close) AS lo, max(close) AS hi FROM sp GROUP BY symbol) a USING (symbol)
JOIN (SELECT symbol, min(close) AS lo, max(close) AS hi FROM sp WHERE split = 'train' GROUP BY symbol) t USING (symbol)""")
def q_params_beside(spark, sf_dir):
    """J2 + K5: scalers stored as version 1 (train split, all symbols) and 2
    (all bars, all but one symbol); each bar gets the newest of its symbol."""
    path = scratch_path(spark, "scalers")
    bars = stored_hourly(spark, sf_dir)
    train = B.chronological_split(bars).where(F.col("split") == "train")
    for v, rows in ((1, train), (2, bars.where(F.col("symbol") != "click"))):
        save_params(X.fit_minmax(rows, ["close"]).withColumn("version", F.lit(v)), path)
    stored = load_params(spark, path).withColumn("version", F.col("version").cast("bigint"))
    return rounded(X.attach_params(bars, stored).select("symbol", "ts", "version", "close_min", "close_max"))
