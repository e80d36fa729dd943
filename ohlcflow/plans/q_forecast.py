"""Forecasting queries over trades (flagship) and resampling."""

from __future__ import annotations

from .. import tables
from ..operators.bars import ticks_to_bars
from ..operators.lstm import FIXED_TEST_WEIGHTS
from . import forecast, oracle
from .registry import register, rounded

# ======================================================================
# Flagship: forecasting from trades
# ======================================================================

@register("forecast_pairs", oracle.sql_forecast_pairs(FIXED_TEST_WEIGHTS) + """
SELECT symbol, ts, R6(actual) AS actual, R6(predicted) AS predicted FROM pairs""")
def q_forecast_pairs(spark, sf_dir):
    return rounded(forecast.forecast_pairs(tables.ticks(spark, sf_dir), "1 hour", 4))


@register("forecast_error", oracle.sql_forecast_pairs(FIXED_TEST_WEIGHTS) + """
SELECT symbol, count(*) AS pairs, R6(avg(abs(actual - predicted))) AS mae,
       R6(sqrt(avg((actual - predicted) * (actual - predicted)))) AS rmse,
       R6(avg((actual - predicted) * (actual - predicted) / 2.0)) AS loss
FROM pairs GROUP BY symbol""")
def q_forecast_error(spark, sf_dir):
    return rounded(forecast.forecast_error(tables.ticks(spark, sf_dir), "1 hour", 4))


# ======================================================================
# R1 resampling
# ======================================================================

@register("bars_hourly", "SELECT symbol, ts, R6(open) AS open, R6(high) AS high, "
          "R6(low) AS low, R6(close) AS close, volume, trade_count, R6(vwap) AS vwap FROM ("
          + oracle.sql_bars_from_ticks("1 hour") + ")")
def q_bars_hourly(spark, sf_dir):
    return rounded(ticks_to_bars(tables.ticks(spark, sf_dir), "1 hour"))
