"""Structured Streaming ingestion (S4, S7, ST1-ST3, ST7, ST8, K3, K4).

Sources are file streams (the message bus is replaced by files in the shared
folder, or by Spark's Kafka source where its connector is on the class
path); sinks are idempotent ``foreachBatch`` writers or file sinks, each
with its own checkpoint location under the shared folder.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bars as B
from ..schema import BAR
from ..session import scratch_path
from ..sources import codec
from ..sources.bus import register_bus
from .store import VersionedStore


# ---------------------------------------------------------------- sources

def table_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A stored table replayed as a stream, ``max_files_per_trigger``
    files per micro-batch (pace with ``trigger(processingTime=...)``).

    A single file is read through its folder with a glob filter, because a
    file stream source needs a directory.
    """
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if os.path.isfile(path.replace("file:", "")):
        r = r.option("pathGlobFilter", os.path.basename(path))
        path = os.path.dirname(path)
    return r.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Subscribe to a topic; the value bytes go through ``decode_stream``.

    Needs Spark's Kafka connector on the class path (not bundled here); the
    decoder is the same for file-fed streams.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load())


def decode_stream(messages: DataFrame, value_col: str = "value", symbol=None) -> DataFrame:
    """ST1 decode: bus value -> typed bars (S4 decoder + S5 flatten)."""
    keep = [c for c in messages.columns if c == "symbol"]
    dec = messages.select(*keep, codec.decode_bar_struct(F.col(value_col)).alias("pdata"))
    sym = F.col("symbol") if keep and symbol is None else symbol
    return codec.flatten_bar(dec, "pdata", sym)


def publish_messages(bars: DataFrame, path: str, quote_numbers: bool = True, mode: str = "overwrite") -> None:
    """Producer side of the replay: bars as JSON messages, one file per day
    (text files with a ``symbol`` column beside the value)."""
    wire = codec.encode_bars_wire(bars.withColumn("day", F.to_date("ts")), quote_numbers, keep=["symbol", "day"])
    (wire.select(F.to_json(F.struct("symbol", "value")).alias("line"), "day")
     .repartition("day").write.mode(mode).partitionBy("day").text(path))


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Consumer side: (symbol, value) messages from the published files."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = r.load(path)
    return lines.select(F.get_json_object("value", "$.symbol").alias("symbol"),
                        F.get_json_object("value", "$.value").alias("value"))


def bus_stream(spark: SparkSession, topic: str, limit: int | None = None, group: str | None = None,
               starting: int = 0) -> DataFrame:
    """S4 + S7: (symbol, value, offset) messages of a topic of the message log,
    ``limit`` a micro-batch (then with the name of the reading ``group``)."""
    register_bus(spark)
    r = spark.readStream.format("bus").option("startingOffset", int(starting))
    if limit:
        r = r.option("maxMessagesPerTrigger", int(limit)).option("group", group)
    return r.load(topic)


def bus_table(spark: SparkSession, topic: str, start: int = 0, end: int | None = None) -> DataFrame:
    """The messages of a topic from offset ``start`` up to ``end``."""
    register_bus(spark)
    r = spark.read.format("bus").option("startingOffset", int(start))
    return (r if end is None else r.option("endingOffset", int(end))).load(topic)


def publish_bus(messages: DataFrame, topic: str) -> None:
    """K2: append (symbol, value) messages to a topic in one commit."""
    register_bus(messages.sparkSession)
    messages.select("symbol", "value").write.format("bus").mode("append").save(topic)


def publish_bus_stream(messages: DataFrame, topic: str, writer: str, checkpoint: str,
                       processing_time: str | None = None) -> StreamingQuery:
    """K2: append a stream of messages; every micro-batch is committed once
    however often it is replayed under the same ``writer``."""
    register_bus(messages.sparkSession)
    w = (messages.select("symbol", "value").writeStream.format("bus").option("writer", writer)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start(topic)


# ---------------------------------------------------------------- operators

def with_event_time(stream: DataFrame, delay: str, col: str = "ts") -> DataFrame:
    """Watermark on ``col``; TIMESTAMP_NTZ is cast to TIMESTAMP (session zone
    UTC) because watermarks need an instant type."""
    return stream.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, delay)


def new_bars_only(bars: DataFrame, delay: str = "1 hour") -> DataFrame:
    """ST3: each (symbol, bar time) once; bars later than the watermark are
    dropped and the dedup state is purged behind it."""
    return with_event_time(bars, delay).dropDuplicates(["symbol", "ts"])


def resample_stream(ticks: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """ST8: R1 on a stream, tumbling windows emitted once closed (append)."""
    t = with_event_time(ticks, delay)
    return B.ticks_to_bars(t, width)


# ---------------------------------------------------------------- sinks

def idempotent_batch_writer(path: str, fmt: str = "parquet", transform: Callable | None = None):
    """K3: a ``foreachBatch`` function writing each micro-batch to its own
    ``batch_id`` partition with overwrite, so a replayed batch replaces its
    earlier output instead of duplicating it."""
    def write(batch: DataFrame, batch_id: int):
        out = transform(batch, batch_id) if transform else batch
        if out is None or out.isEmpty():              # P4 empty-batch guard
            return
        (out.write.mode("overwrite").format(fmt)
         .save(f"{path.rstrip('/')}/batch_id={int(batch_id)}"))
    return write


def start(stream: DataFrame, name: str, spark: SparkSession, sink: str = "parquet",
          output_mode: str = "append", foreach_batch=None, available_now: bool = True,
          processing_time: str | None = None, out_path: str | None = None):
    """K4: start a query with its own checkpoint under the shared folder.

    Returns (query, output path). ``available_now`` processes what is there
    and stops; ``processing_time`` paces a long-running query instead.
    """
    out = out_path or scratch_path(spark, f"stream-{name}")
    w = stream.writeStream.queryName(f"{name}_{os.path.basename(out)}") \
        .option("checkpointLocation", f"{out}/_checkpoint").outputMode(output_mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink).option("path", f"{out}/data")
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start(), out


def run_to_completion(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """ST7: block until any active query stops (or the timeout)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return spark.streams.awaitAnyTermination(int(timeout_s * 1000))


class ProgressLog:
    """ST7: a listener that keeps the last progress of every query."""

    def __init__(self):
        from pyspark.sql.streaming import StreamingQueryListener

        log = self

        class _L(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                log.progress[str(event.progress.id)] = event.progress

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                log.terminated.add(str(event.id))

        self.progress, self.terminated = {}, set()
        self.listener = _L()

    def attach(self, spark: SparkSession) -> "ProgressLog":
        spark.streams.addListener(self.listener)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self.listener)


def bar_store(spark: SparkSession, path: str, capacity: int, **options) -> VersionedStore:
    """ST2: the store of the newest ``capacity`` bars of every symbol."""
    return VersionedStore(spark, path, BAR, capacity, day=F.to_date("ts"), **options)


def rolling_dataset_writer(store: VersionedStore):
    """ST2: a ``foreachBatch`` function that appends each micro-batch of bars to
    the store, once however often it is replayed."""
    def write(batch: DataFrame, batch_id: int):
        if not batch.isEmpty():                       # P4
            store.append(batch, batch_id)
    return write
