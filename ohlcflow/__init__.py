"""ohlcflow: Spark-native OHLCV bar forecasting and labelled-text classification.

Every operator is a function from DataFrame(s) to DataFrame built with the
DataFrame / SQL API, so Catalyst plans it and AQE re-plans it at run time.
Python workers appear only where Spark has no built-in (LSTM training and
bulk scoring, keyed streaming state).
"""

__version__ = "0.1.0"
