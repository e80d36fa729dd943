"""Struct types of the data model."""

from pyspark.sql import types as T

# A bar: one OHLCV row of one symbol at one bar start.
BAR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("vwap", T.DoubleType()),
])

BAR_COLUMNS = [f.name for f in BAR.fields]
PRICE_COLUMNS = ["open", "high", "low", "close", "vwap"]

# CSV header of a stored bar file, in file order.
CSV_BAR = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("Trade_count", T.LongType()),
    T.StructField("vwap", T.DoubleType()),
])
CSV_BAR_COLUMNS = [f.name for f in CSV_BAR.fields]

# A bar message as it travels on the message bus. Numbers may arrive quoted,
# so every field is decoded as text first and cast afterwards.
WIRE_BAR = T.StructType([T.StructField(n, T.StringType()) for n in CSV_BAR_COLUMNS])

# Daily price file: M/d/yyyy dates and grouped integer volumes.
DAILY_CSV = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.StringType()),
])

# One gate row of an LSTM parameter set.
PARAMS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("gate", T.StringType()),
    T.StructField("w", T.ArrayType(T.DoubleType())),
    T.StructField("u", T.DoubleType()),
    T.StructField("b", T.DoubleType()),
])

PREDICTION = T.StructType([
    T.StructField("currentPrice", T.DoubleType()),
    T.StructField("predictedPrice", T.DoubleType()),
])

# Gate order used everywhere: input activation, input, forget, output.
GATES = ["a", "i", "f", "o"]
