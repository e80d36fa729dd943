"""A versioned rolling table with a commit log (ST2, ST6, K5).

The table keeps the newest ``capacity`` rows of every key. Micro-batches are
written as delta folders; every ``max_deltas`` batches the live rows are written
anew as one base, partitioned by day where a time column says so, and rows
beyond the capacity are left out. What is read is one base and a few deltas,
however long the stream has run.

A version is a small JSON manifest (last batch, base, deltas). Data go first,
the manifest last, by a rename that fails where the version exists, so a
version is there whole or not at all; readers are bound to one. A batch that
the log holds is not written again. After a crash, before or after any of these
steps, replaying the batch leaves the same table; folders that no version
refers to go with the next clean-up, which keeps the newest ``keep_versions``.

One writer at a time (a streaming query's ``foreachBatch``); a second one fails
at its commit. All file work goes through the Hadoop file system of the path.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window


class CommitLog:
    """Versions as JSON manifests below ``root``/_log."""

    nothing: dict = {"version": 0}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    # ------------------------------------------------------------ files
    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _list(self, name: str) -> list[str]:
        p = self._path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _read_json(self, name: str) -> dict:
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._list("_log") if re.fullmatch(r"\d{20}\.json", n)]

    def manifest(self, version: int) -> dict:
        return self._read_json(f"_log/{version:020d}.json") if version else dict(self.nothing)

    def latest(self) -> dict:
        return self.manifest(max(self.versions(), default=0))

    def _commit(self, old: dict, **changes) -> dict:
        """Make ``old`` with ``changes`` the next version."""
        new = {**old, **changes, "version": old["version"] + 1}
        name = f"_log/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(name), False)
        try:
            out.write(bytearray(json.dumps(new, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        plain = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf) \
            if self._path("").toUri().getScheme() else self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._conf)
        files.rename(self._path(name), self._path(f"_log/{new['version']:020d}.json"), plain)
        return new


class VersionedStore(CommitLog):
    """Rows of ``schema``; ``order`` says which rows of a key are newest."""

    nothing = {"version": 0, "batch": -1, "base": None, "deltas": []}

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, capacity: int,
                 keys: Sequence[str] = ("symbol",), order: str = "ts", day: Column | None = None,
                 max_deltas: int = 8, keep_versions: int = 4):
        super().__init__(spark, root)
        self.schema = schema
        self.capacity, self.keys, self.order, self.day = int(capacity), list(keys), order, day
        self.max_deltas, self.keep_versions = int(max_deltas), int(keep_versions)

    def at_batch(self, batch_id: int) -> dict:
        """The newest kept version that holds no batch after ``batch_id``."""
        for v in sorted(self.versions(), reverse=True):
            m = self.manifest(v)
            if m["batch"] <= batch_id:
                return m
        if self.versions() and min(self.versions()) > 1:
            raise LookupError(f"the version of batch {batch_id} is no longer kept")
        return dict(self.nothing)

    def committed(self, batch_id: int) -> bool:
        return self.latest()["batch"] >= int(batch_id)

    # ------------------------------------------------------------ rows
    def _folder(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{name}")

    def read(self, version: dict | None = None) -> DataFrame:
        """All rows of a version, those beyond the capacity included."""
        m = self.latest() if version is None else version
        out = self.spark.createDataFrame([], self.schema)
        for name in ([m["base"]] if m["base"] else []) + m["deltas"]:
            out = out.union(self._folder(name).select(*self.schema.names))
        return out

    def view(self, version: dict | None = None) -> DataFrame:
        """The newest ``capacity`` rows of every key. A key has at most that
        many rows in the base and those of a few deltas, so its window is small."""
        rows = self.read(version)
        newest = Window.partitionBy(*self.keys).orderBy(F.desc(self.order), F.xxhash64(*self.schema.names))
        return (rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= self.capacity)
                .drop("_rank"))

    def append(self, batch: DataFrame, batch_id: int) -> dict:
        """Add a micro-batch once; returns its version."""
        if self.committed(batch_id):
            return self.at_batch(batch_id)
        old, name = self.latest(), f"batch-{int(batch_id):012d}-{uuid.uuid4().hex}"
        batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.parquet(
            f"{self.root}/data/{name}")
        new = self._commit(old, batch=int(batch_id), deltas=[*old["deltas"], name])
        if len(new["deltas"]) >= self.max_deltas:
            new = self.compact(new)
        self.clean()
        return new

    def compact(self, old: dict) -> dict:
        """One base of the live rows in place of base and deltas."""
        name, rows = f"base-{uuid.uuid4().hex}", self.view(old)
        if self.day is None:
            rows.write.parquet(f"{self.root}/data/{name}")
        else:
            rows = rows.withColumn("_day", self.day)
            rows.hint("rebalance", "_day").write.partitionBy("_day").parquet(f"{self.root}/data/{name}")
        return self._commit(old, base=name, deltas=[])

    def clean(self) -> None:
        """Forget all but the newest versions, then delete what none refers to."""
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-self.keep_versions:]]
        for v in versions[:-self.keep_versions]:
            self._fs.delete(self._path(f"_log/{v:020d}.json"), False)
        live = {n for m in kept for n in [m["base"], *m["deltas"]]}
        for name in self._list("data"):
            if name not in live:
                self._fs.delete(self._path(f"data/{name}"), True)

    def size(self, version: dict | None = None) -> int:
        """Bytes that a reader of the version reads."""
        m = self.latest() if version is None else version
        return sum(self._fs.getContentSummary(self._path(f"data/{n}")).getLength()
                   for n in ([m["base"]] if m["base"] else []) + m["deltas"])
