"""Row numbers of a growing series, kept by deltas.

``operators.series.index_series`` numbers a whole table. Over a stream that is
the whole history for every micro-batch. ``SeriesIndex`` stores what it computes
instead: rows in one folder a time bucket, numbered inside (key, bucket), and a
table of row counts by (key, bucket). A batch reads and writes the buckets that
it touches, whether new or late, and adds one signed row a touched (key, bucket)
to the counts; no other row is read. The offset of a bucket is the sum of the
counts before it, taken over that small table when rows are read, so a late bar
moves all later numbers without a rewrite.

The manifest names the folder of every bucket and the files of the counts (a
base and a few deltas); it is committed last (``store.CommitLog``), a committed
batch is not applied again, and a crash between the steps leaves folders that no
version refers to. One writer at a time.

A row whose key and order columns are there already takes the place of the old
one (a corrected bar); of several such in one batch that of the greatest hash
stays. Rows without a key or a time have no place in a series and are left out,
as ``index_series`` does.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import CommitLog


class SeriesIndex(CommitLog):
    """Rows of ``schema`` in the order of ``order`` within ``keys``; ``bucket``
    is a ``date_trunc`` unit, chosen as for ``index_series``."""

    nothing = {"version": 0, "batch": -1, "buckets": {}, "counts": []}

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str] = ("symbol",),
                 order: str = "ts", bucket: str = "day", max_deltas: int = 8, keep_versions: int = 4):
        super().__init__(spark, root)
        self.schema, self.keys, self.order, self.bucket = schema, list(keys), order, bucket
        self.max_deltas, self.keep_versions = int(max_deltas), int(keep_versions)
        self._rows = T.StructType([*schema.fields, T.StructField("_bkt", T.LongType()), T.StructField("_rib", T.LongType())])
        self._counts = T.StructType([*(schema[k] for k in self.keys), T.StructField("_bkt", T.LongType()),
                                     T.StructField("_cnt", T.LongType())])

    def _place(self):
        """The bucket of a row: microseconds of its start."""
        return F.unix_micros(F.date_trunc(self.bucket, F.col(self.order)).cast("timestamp"))

    def _stored(self, manifest: dict, buckets) -> DataFrame:
        paths = [f"{self.root}/{manifest['buckets'][b]}" for b in buckets if b in manifest["buckets"]]
        # The folders of the buckets are the roots of the read: no column is
        # taken from their names.
        return self.spark.read.schema(self._rows).parquet(*paths) if paths else self.spark.createDataFrame([], self._rows)

    def counts(self, manifest: dict | None = None) -> DataFrame:
        """(keys, _bkt, _cnt): rows of every (key, bucket)."""
        m = self.latest() if manifest is None else manifest
        if not m["counts"]:
            return self.spark.createDataFrame([], self._counts)
        rows = self.spark.read.schema(self._counts).parquet(*[f"{self.root}/{n}" for n in m["counts"]])
        return rows.groupBy(*self.keys, "_bkt").agg(F.sum("_cnt").alias("_cnt")).where(F.col("_cnt") > 0)

    def offsets(self, manifest: dict | None = None) -> DataFrame:
        """(keys, _bkt, _cnt, _off, _n): one row a (key, bucket)."""
        whole = Window.partitionBy(*self.keys)
        before = whole.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
        return (self.counts(manifest).withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
                .withColumn("_n", F.sum("_cnt").over(whole)))

    # ------------------------------------------------------------ writing
    def append(self, batch: DataFrame, batch_id: int) -> dict:
        """Add a micro-batch once; returns the manifest of its version."""
        old = self.latest()
        if old["batch"] >= int(batch_id):
            return old
        name = f"batch-{int(batch_id):012d}-{uuid.uuid4().hex}"
        new = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        for c in (*self.keys, self.order):
            new = new.where(F.col(c).isNotNull())
        # The batch is written once: its buckets are asked for first, then its rows.
        new.withColumn("_bkt", self._place()).write.parquet(f"{self.root}/data/{name}/new")
        new = self.spark.read.parquet(f"{self.root}/data/{name}/new")
        touched = [str(r[0]) for r in new.select("_bkt").distinct().collect()]          # time buckets of one batch
        if touched:
            buckets, counts = self._rewrite(old, new, touched, name)
        else:
            buckets, counts = old["buckets"], old["counts"]
        done = self._commit(old, batch=int(batch_id), buckets=buckets, counts=counts)
        if len(done["counts"]) > self.max_deltas:
            done = self.compact(done)
        self.clean()
        return done

    def _rewrite(self, old: dict, new: DataFrame, touched: list, name: str):
        there = self._stored(old, touched)
        cols = [*self.schema.names, "_bkt"]
        both = (there.select(*cols, F.lit(0).alias("_age"))
                .unionByName(new.select(*cols, F.lit(1).alias("_age"))))
        one = Window.partitionBy(*self.keys, "_bkt", self.order).orderBy(F.desc("_age"), F.desc(F.xxhash64(*self.schema.names)))
        local = Window.partitionBy(*self.keys, "_bkt").orderBy(self.order)
        rows = (both.withColumn("_rank", F.row_number().over(one)).where(F.col("_rank") == 1)
                .withColumn("_rib", (F.row_number().over(local) - 1).cast("long"))
                .select(*cols, "_rib").withColumn("_folder", F.col("_bkt")))
        rows.hint("rebalance", "_folder").write.partitionBy("_folder").parquet(f"{self.root}/data/{name}/rows")
        buckets = {**old["buckets"], **{b: f"data/{name}/rows/_folder={b}" for b in touched}}
        now = self._stored({"buckets": buckets}, touched)
        change = (now.select(*self.keys, "_bkt", F.lit(1).alias("_one"))
                  .unionByName(there.select(*self.keys, "_bkt", F.lit(-1).alias("_one")))
                  .groupBy(*self.keys, "_bkt").agg(F.sum("_one").alias("_cnt")).where(F.col("_cnt") != 0))
        change.write.parquet(f"{self.root}/data/{name}/counts")
        return buckets, [*old["counts"], f"data/{name}/counts"]

    def compact(self, old: dict) -> dict:
        """One table of counts in place of all."""
        name = f"data/counts-{uuid.uuid4().hex}/counts"
        self.counts(old).write.parquet(f"{self.root}/{name}")
        return self._commit(old, counts=[name])

    def clean(self) -> None:
        """Forget all but the newest versions and delete what none refers to."""
        versions = self.versions()
        live = {p for v in versions[-self.keep_versions:] for m in [self.manifest(v)]
                for p in [*m["buckets"].values(), *m["counts"]]}
        for v in versions[:-self.keep_versions]:
            self._fs.delete(self._path(f"_log/{v:020d}.json"), False)
        for name in self._list("data"):
            parts = [f"data/{name}/counts", f"data/{name}/new",
                     *(f"data/{name}/rows/{b}" for b in self._list(f"data/{name}/rows") if b.startswith("_folder="))]
            for p in (set(parts) - live) if live & set(parts) else [f"data/{name}"]:
                self._fs.delete(self._path(p), True)

    # ------------------------------------------------------------ reading
    def _numbered(self, m: dict, buckets, offsets: DataFrame) -> DataFrame:
        # A row a (key, bucket): AQE broadcasts the offsets while they are
        # small and joins by (key, bucket) beyond.
        rows = self._stored(m, buckets).join(offsets, [*self.keys, "_bkt"], "inner")
        return rows.withColumn("_g", F.col("_off") + F.col("_rib")).select(*self.schema.names, "_g", "_n")

    def read(self, manifest: dict | None = None) -> DataFrame:
        """All rows with ``_g`` and ``_n``, as ``index_series`` gives them:
        windows, splits and tails over it number nothing anew."""
        m = self.latest() if manifest is None else manifest
        return self._numbered(m, list(m["buckets"]), self.offsets(m))

    def newest(self, rows: int, manifest: dict | None = None) -> DataFrame:
        """The newest ``rows`` rows of every key (L2). Only folders of buckets
        that hold some of them are read."""
        m = self.latest() if manifest is None else manifest
        offsets = self.offsets(m).where(F.col("_off") + F.col("_cnt") > F.col("_n") - F.lit(int(rows)))
        buckets = [str(r[0]) for r in offsets.select("_bkt").distinct().collect()]      # names of folders
        return self._numbered(m, buckets, offsets).where(F.col("_g") >= F.col("_n") - F.lit(int(rows)))

    def size(self, manifest: dict | None = None) -> int:
        """Bytes of the rows and counts of a version."""
        m = self.latest() if manifest is None else manifest
        return sum(self._fs.getContentSummary(self._path(p)).getLength() for p in [*m["buckets"].values(), *m["counts"]])

    def starts(self, manifest: dict | None = None) -> list:
        """Starts of the buckets of a version, in order."""
        m = self.latest() if manifest is None else manifest
        return [datetime.fromtimestamp(b / 1e6, timezone.utc) for b in sorted(int(b) for b in m["buckets"])]
