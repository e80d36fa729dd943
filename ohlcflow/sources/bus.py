"""A message log as a Spark data source (S4, S7, K2): ``format("bus")``.

A topic is a folder that all workers share and see as a mounted path. Messages are rows (symbol,
value) in Parquet segments, one a writing task; each gets an offset, counted
from 0 without gaps. A commit is a small JSON manifest (first and end offset,
segments, last batch of every streaming writer), linked under the next version
number: that fails where the number exists, so commits are whole, ordered and
never overwrite each other. Segments of failed tasks are in no manifest and are
never read.

* Batch and streaming writes: tasks return their segment in the commit message,
  the driver commits once. A streaming writer (option ``writer``) replaying a
  batch commits it only if the log does not hold it.
* Streaming reads hand out offsets; option ``maxMessagesPerTrigger`` paces the
  replay and needs a ``group``, whose planned offset is kept in the topic beside
  the query's checkpoint, because a reader is asked for its newest offset before
  it learns where the query stands. Without a limit no group is needed.
  Use a processing-time trigger with a limit: ``availableNow`` asks once.
* Batch reads take ``startingOffset`` (0) and ``endingOffset`` (the newest).

A read's tasks are the segments it touches, each reading its own rows only.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

MESSAGE = "symbol string, value string, offset bigint"


def local_path(uri: str) -> str:
    """The mounted path of a plain or ``file:`` address."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"a topic needs a mounted path, not {uri}")
    return parts.path


def _write_new(path: str, content: dict) -> None:
    """Create a file whole; FileExistsError where it exists."""
    held = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}")
    with open(held, "w", encoding="utf-8") as f:
        json.dump(content, f, sort_keys=True)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(held, path)
    finally:
        os.unlink(held)


@dataclass
class Segment(WriterCommitMessage):
    name: str
    rows: int


@dataclass
class Slice(InputPartition):
    name: str
    skip: int
    rows: int
    first: int                                   # offset of the first row of the slice


@dataclass
class Topic:
    """The manifests of one folder; each is read once, as they never change."""

    root: str
    held: list = field(default_factory=list)

    def refresh(self) -> "Topic":
        while True:
            try:
                with open(self._manifest(len(self.held)), encoding="utf-8") as f:
                    self.held.append(json.load(f))
            except FileNotFoundError:
                return self

    def _manifest(self, version: int) -> str:
        return os.path.join(self.root, "_log", f"{version:020d}.json")

    @property
    def end(self) -> int:
        return self.held[-1]["end"] if self.held else 0

    def commit(self, segments: list, writer: str | None = None, batch: int | None = None) -> None:
        """Append the segments of one write; none where the writer's batch is there."""
        os.makedirs(os.path.join(self.root, "_log"), exist_ok=True)
        while True:
            self.refresh()
            writers = dict(self.held[-1]["writers"]) if self.held else {}
            if writer is not None:
                if writers.get(writer, -1) >= batch:
                    return
                writers[writer] = batch
            elif not segments:
                return
            new = {"first": self.end, "end": self.end + sum(s.rows for s in segments), "writers": writers,
                   "segments": [[s.name, s.rows] for s in segments]}
            try:
                return _write_new(self._manifest(len(self.held)), new)
            except FileExistsError:              # another writer was first: after it, then
                continue

    def slices(self, start: int, end: int) -> list[Slice]:
        """What holds the offsets from ``start`` up to ``end``."""
        if not 0 <= start <= end <= self.end:
            raise ValueError(f"offsets {start} to {end} of a topic that ends at {self.end}")
        out = []
        for m in self.held:
            at = m["first"]
            if m["end"] <= start or at >= end:
                continue
            for name, rows in m["segments"]:
                a, b = max(start, at), min(end, at + rows)
                if a < b:
                    out.append(Slice(name, a - at, b - a, a))
                at += rows
        return out


def _read(root: str, part: Slice):
    """Arrow batches of a slice, read from the row groups that hold it."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    file = pq.ParquetFile(os.path.join(root, "data", part.name))
    skip, left, offset, groups = part.skip, part.rows, part.first, []
    for g in range(file.num_row_groups):
        n = file.metadata.row_group(g).num_rows
        if not groups and skip >= n:
            skip -= n
        else:
            groups.append(g)
    for b in file.iter_batches(row_groups=groups, columns=["symbol", "value"]):
        n = b.num_rows
        b, skip = b.slice(min(skip, n), left), max(0, skip - n)
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(range(offset, offset + b.num_rows), pa.int64())],
                                             names=["symbol", "value", "offset"])
            offset, left = offset + b.num_rows, left - b.num_rows
        if not left:
            return


class _BatchReader(DataSourceReader):
    def __init__(self, root: str, options):
        self.root, topic = root, Topic(root).refresh()
        self.parts = topic.slices(int(options.get("startingOffset", 0)), int(options.get("endingOffset", topic.end)))

    def partitions(self):
        return self.parts or [Slice("", 0, 0, 0)]

    def read(self, partition):
        if partition.rows:
            yield from _read(self.root, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, root: str, options):
        self.root, self.topic = root, Topic(root)
        self.first = int(options.get("startingOffset", 0))
        self.limit, self.group = int(options.get("maxMessagesPerTrigger", 0)), options.get("group")
        if self.limit and not self.group:
            raise ValueError("maxMessagesPerTrigger needs a group")

    def _place(self) -> str:
        return os.path.join(self.root, "_groups", f"{self.group}.json")

    def initialOffset(self) -> dict:
        return {"offset": self.first}

    def latestOffset(self) -> dict:
        end = self.topic.refresh().end
        if self.limit:
            try:
                with open(self._place(), encoding="utf-8") as f:
                    at = json.load(f)["offset"]
            except FileNotFoundError:
                at = self.first
            end = min(end, at + self.limit)
        return {"offset": max(end, self.first)}

    def partitions(self, start: dict, end: dict):
        parts = self.topic.refresh().slices(start["offset"], end["offset"])
        if self.limit:                           # known before the batch runs, so never behind the checkpoint
            os.makedirs(os.path.dirname(self._place()), exist_ok=True)
            held = f"{self._place()}.{uuid.uuid4().hex}"
            with open(held, "w", encoding="utf-8") as f:
                json.dump(end, f)
            os.replace(held, self._place())
        return parts

    def read(self, partition):
        return _read(self.root, partition)


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.parquet as pq

        shape = pa.schema([("symbol", pa.string()), ("value", pa.string())])
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        os.makedirs(os.path.join(self.root, "data"), exist_ok=True)
        for b in iterator:
            if not b.num_rows:
                continue
            out = out or pq.ParquetWriter(os.path.join(self.root, "data", name), shape, compression="zstd")
            table = pa.Table.from_batches([b]).select(["symbol", "value"]).cast(shape)
            out.write_table(table, row_group_size=1 << 16)
            rows += b.num_rows
        if out:
            out.close()
        return Segment(name, rows)

    def commit(self, messages):
        Topic(self.root).commit(_written(messages))


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, root: str, options):
        self.root, self.writer = root, options.get("writer")
        if not self.writer:
            raise ValueError("a streaming write needs the name of its writer")

    write = _Writer.write

    def commit(self, messages, batchId):
        Topic(self.root).commit(_written(messages), self.writer, int(batchId))


def _written(messages) -> list[Segment]:
    return sorted((m for m in messages if m is not None and m.rows), key=lambda s: s.name)


class BusSource(DataSource):
    @classmethod
    def name(cls):
        return "bus"

    def schema(self):
        return MESSAGE

    @property
    def root(self) -> str:
        return local_path(self.options["path"])

    def reader(self, schema):
        return _BatchReader(self.root, self.options)

    def streamReader(self, schema):
        return _StreamReader(self.root, self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a topic is appended to, never overwritten")
        return _Writer(self.root)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.root, self.options)


def register_bus(spark: SparkSession) -> None:
    """Make ``format("bus")`` known to the session."""
    spark.dataSource.register(BusSource)
