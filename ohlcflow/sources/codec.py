"""Message codecs: bar JSON on the bus (S4 decoder, S5, K2, F9) and broker
frames (S6). All JSON work is ``from_json`` / ``to_json`` on the JVM side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import parse_bar_time
from ..schema import CSV_BAR_COLUMNS, WIRE_BAR

# CSV field -> engine column
CSV_TO_BAR = {"Date": "ts", "Open": "open", "High": "high", "Low": "low", "Close": "close",
              "Volume": "volume", "Trade_count": "trade_count", "vwap": "vwap"}
BAR_TYPES = {"open": "double", "high": "double", "low": "double", "close": "double",
             "volume": "bigint", "trade_count": "bigint", "vwap": "double"}

# Broker message keys (type, symbol, time, open, high, low,
# close, volume, trade count, vwap) and the message type of a bar.
FRAME_KEYS = {"type": "T", "symbol": "S", "ts": "t", "open": "o", "high": "h", "low": "l",
              "close": "c", "volume": "v", "trade_count": "n", "vwap": "vw"}
BAR_MESSAGE = "b"


def encode_json(df: DataFrame, cols: Sequence[str] | None = None, quote_numbers: bool = False,
                names: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """K2 codec: each row -> one JSON text column ``value``.

    ``quote_numbers`` writes every field as a string, like the live producer;
    ``names`` renames fields on the wire.
    """
    cols = list(cols or df.columns)
    names = names or {}
    fields = []
    for c in cols:
        v = F.col(c)
        if quote_numbers:
            v = v.cast("string")
        fields.append(v.alias(names.get(c, c)))
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def decode_bar_struct(value: Column) -> Column:
    """S4 decoder (Q1): JSON text/bytes -> struct of strings in CSV order.

    Decoding every field as text accepts quoted and bare numbers alike; a
    DOUBLE field would turn ``"118.9"`` into null.
    """
    return F.from_json(value.cast("string"), WIRE_BAR)


def flatten_bar(df: DataFrame, struct_col: str = "pdata", symbol: Column | str | None = None) -> DataFrame:
    """S5 + P7 + F10: struct -> typed engine bar columns in fixed order."""
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    out = [(sym if sym is not None else F.lit(None).cast("string")).alias("symbol"),
           parse_bar_time(F.col(f"{struct_col}.Date")).alias("ts")]
    for c in CSV_BAR_COLUMNS[1:]:
        out.append(F.col(f"{struct_col}.{c}").try_cast(BAR_TYPES[CSV_TO_BAR[c]]).alias(CSV_TO_BAR[c]))
    return df.select(*out)


def decode_bars(df: DataFrame, value_col: str = "value", symbol=None) -> DataFrame:
    """Bus value -> bars (S4 decode + S5 flatten)."""
    return flatten_bar(df.select(decode_bar_struct(F.col(value_col)).alias("pdata")), "pdata", symbol)


def encode_bars_wire(bars: DataFrame, quote_numbers: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Bars -> bus messages with CSV field names (the producer's format)."""
    names = {v: k for k, v in CSV_TO_BAR.items()}
    df = bars.withColumn("ts", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ssXXX"))
    return encode_json(df, ["ts", *BAR_TYPES], quote_numbers, names, keep)


def encode_frames(messages: DataFrame, group: Sequence[str]) -> DataFrame:
    """Broker frames: JSON arrays of messages; each input row holds one frame
    as an array column ``msgs`` of structs keyed like ``FRAME_KEYS``."""
    return messages.select(*group, F.to_json(F.col("msgs")).alias("value"))


def bar_message(bars: DataFrame, type_code: str = BAR_MESSAGE) -> Column:
    """Struct of one broker message from bar columns (numbers stay numbers)."""
    return F.struct(F.lit(type_code).alias(FRAME_KEYS["type"]),
                    F.col("symbol").alias(FRAME_KEYS["symbol"]),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(FRAME_KEYS["ts"]),
                    *[F.col(c).alias(FRAME_KEYS[c]) for c in BAR_TYPES])


def decode_frames(frames: DataFrame, value_col: str = "value", allowed: Sequence[str] = (BAR_MESSAGE,)) -> DataFrame:
    """S6 + P6: broker frames -> bars of the allowed message types.

    Each frame is a JSON array of messages; all messages are exploded (the
    reference fails on frames with more than one). Messages are decoded as
    string maps, so keys that differ only by case (``T`` type, ``t`` time)
    stay distinct without a case-sensitive session.
    """
    m = F.explode(F.from_json(F.col(value_col).cast("string"), "array<map<string,string>>")).alias("m")
    msgs = frames.select(m).where(F.col("m")[FRAME_KEYS["type"]].isin(list(allowed)))
    out = [F.col("m")[FRAME_KEYS["symbol"]].alias("symbol"),
           parse_bar_time(F.col("m")[FRAME_KEYS["ts"]]).alias("ts")]
    for c, t in BAR_TYPES.items():
        out.append(F.col("m")[FRAME_KEYS[c]].try_cast(t).alias(c))
    return msgs.select(*out)


def publish_kafka(df: DataFrame, servers: str, topic: str, cols: Sequence[str] | None = None,
                  checkpoint: str | None = None):
    """K2 sink: rows as JSON values on a topic, batch or streaming.

    Needs Spark's Kafka connector on the class path; the value codec is
    ``encode_json`` and is tested without a broker.
    """
    out = encode_json(df, cols)
    if df.isStreaming:
        w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("topic", topic))
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None


def prediction_event(current, predicted) -> Column:
    """K2 payload of the forecaster: {"currentPrice", "predictedPrice"}."""
    return F.to_json(F.struct(F.col(current).cast("double").alias("currentPrice"),
                              F.col(predicted).cast("double").alias("predictedPrice")))
