"""LSTM training and bulk-scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables
from ..operators import lstm as L
from ..operators import lstm_train as LT
from . import training as TR
from .oracle import sql_bars_from_ticks, sql_forecast_pairs, sql_train_in_order, sql_window_gradients
from .q_bars import daily, hourly
from .registry import register, rounded

FIXED = L.theta_from_gates(L.FIXED_TEST_WEIGHTS)
GRADIENT_SQL = sql_window_gradients(L.FIXED_TEST_WEIGHTS, sql_bars_from_ticks("1 hour"), 4)


@register("forecast_pairs_bulk", sql_forecast_pairs(L.FIXED_TEST_WEIGHTS) + """
SELECT symbol, ts, R6(actual) AS actual, R6(predicted) AS predicted FROM pairs""")
def q_bulk(spark, sf_dir):
    """M2: numpy scoring in (symbol, chunk) groups equals the Catalyst fold."""
    return rounded(TR.forecast_pairs_bulk(tables.ticks(spark, sf_dir)))


@register("lstm_init", """SELECT symbol, CAST(k AS INTEGER) AS position,
  R6(('0x' || substr(md5(symbol || ':0:' || k), 1, 8))::BIGINT / 4294967296.0) AS theta
  FROM (SELECT DISTINCT event_type AS symbol FROM events), range(16) r(k)""")
def q_init(spark, sf_dir):
    """M0: seeded initial weights of every symbol, two features."""
    symbols = tables.ticks(spark, sf_dir).select("symbol").distinct()
    return rounded(symbols.select("symbol", F.posexplode(LT.init_theta_column("symbol", 2)).alias("position", "theta")))


@register("lstm_sgd_step", GRADIENT_SQL + f"""
SELECT symbol, CAST(k AS INTEGER) AS position, R6(({FIXED.tolist()})[k + 1] - 0.1 * g / steps) AS theta
FROM (SELECT symbol, unnest(range(16)) AS k, unnest(grad) AS g, steps FROM per_symbol)""")
def q_step(spark, sf_dir):
    """M4 / M5: the fixed weights after one step of rate 0.1 against the mean
    gradient of all windows of 4 hourly bars of the symbol."""
    rows = TR.scaled_series(hourly(spark, sf_dir), ["close", "volume"])
    init = rows.select("symbol").distinct().withColumn("theta", F.array(*[F.lit(v) for v in FIXED.tolist()]))
    out = LT.train_per_symbol(rows, ["close_s", "volume_s"], "target_s", 4, 1, 0.1, init=init)
    return rounded(out.select("symbol", F.posexplode("theta").alias("position", "theta")))


@register("lstm_train_in_order", lambda: sql_train_in_order(
    L.FIXED_TEST_WEIGHTS, sql_bars_from_ticks("1 hour"), 4, 0.1, 2) + f"""
SELECT symbol, CAST(k AS INTEGER) AS position, R6(v) AS theta
FROM (SELECT symbol, unnest(range(16)) AS k, unnest([{", ".join(f"th{k}" for k in range(16))}]) AS v FROM trained)""")
def q_in_order(spark, sf_dir):
    """M5: the fixed weights after two epochs over every window of 4 hourly
    bars of the symbol, with an update of rate 0.1 after each; chunks of 256
    bars, so that a symbol's parameters pass through several waves."""
    rows = TR.scaled_series(hourly(spark, sf_dir), ["close", "volume"])
    init = rows.select("symbol").distinct().withColumn("theta", F.array(*[F.lit(v) for v in FIXED.tolist()]))
    out = LT.train_in_order(rows, ["close_s", "volume_s"], "target_s", 4, 2, 0.1, init=init, chunk_rows=256)
    return rounded(out.where("windows > 0").select("symbol", F.posexplode("theta").alias("position", "theta")))


@register("lstm_train_per_symbol")
def q_train(spark, sf_dir):
    """M5 + K5 layout: window 72, 4 epochs, lr 1 on all hourly bars."""
    trained = TR.train_symbols(hourly(spark, sf_dir))
    return L.thetas_to_params(trained, len(TR.BAR_FEATURES))


@register("lstm_train_grid")
def q_grid(spark, sf_dir):
    """Per (symbol, grid point) training loss."""
    grid = [dict(b=24, epochs=2, lr=0.1), dict(b=48, epochs=2, lr=0.5), dict(b=72, epochs=4, lr=1.0)]
    return TR.train_symbols(hourly(spark, sf_dir), grid=grid).drop("theta")


@register("lstm_train_distributed")
def q_distributed(spark, sf_dir):
    """M6: full-batch epochs over the pooled windows of all symbols."""
    return TR.train_pooled(spark, hourly(spark, sf_dir), b=24, epochs=3).drop("theta")


@register("lstm_warm_start")
def q_warm(spark, sf_dir):
    """M7: train, store, reload, continue training, store version 2."""
    return TR.warm_start(spark, hourly(spark, sf_dir), b=24, epochs=1, lr=0.5)


@register("lstm_gradients", GRADIENT_SQL + """
SELECT CAST(k AS INTEGER) AS position, R6(sum(g)) AS grad, R6(sum(loss)) AS loss, CAST(sum(steps) AS BIGINT) AS steps
FROM (SELECT unnest(range(16)) AS k, unnest(grad) AS g, loss, steps FROM per_symbol) GROUP BY k""")
def q_gradients(spark, sf_dir):
    """M3 + A8: BPTT gradient of the fixed weights over every window of 4
    hourly bars, one row per chunk summed to one, a line per weight."""
    chunks = TR.pooled_chunks(hourly(spark, sf_dir), 4)
    g, loss, steps = LT.sum_gradients(LT.gradient_rows(chunks, 2, theta=FIXED, b=4), FIXED.size)
    rows = [(k, float(v), loss, steps) for k, v in enumerate(g)]
    return rounded(spark.createDataFrame(rows, "position int, grad double, loss double, steps long"))


@register("lag60_forecast")
def q_lag60(spark, sf_dir):
    """60-lag daily forecaster, real vs predicted on the test split."""
    return rounded(TR.lag60_forecast(spark, daily(spark, sf_dir)))


@register("lag60_open_forecast")
def q_lag60_open(spark, sf_dir):
    """M11 on the opening price."""
    return rounded(TR.lag60_forecast(spark, daily(spark, sf_dir), column="open"))
