"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (bars are UTC instants),
# AQE with runtime broadcast conversion and skew-join splitting, Arrow
# batches for the few Python workers, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "ohlcflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (roughly input bytes / 128 MB) or leave
    it to AQE coalescing.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers.

    Worker-side functions (pandas UDFs, keyed state) refer to module code, so
    executors need the package: it is zipped once per application and
    distributed with ``addPyFile`` (the runtime form of ``--py-files``).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = tempfile.mkdtemp(prefix="ohlcflow-pyfiles-")
    zpath = os.path.join(out, "ohlcflow.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _dirs, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where nothing is configured, a local master (tests,
    a laptop) gets a private folder, so that ``checkpoint()`` and written
    intermediate tables work the same way everywhere; on a cluster that would
    be a disk no executor sees, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="ohlcflow-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (for stream sinks,
    checkpoint locations and materialised intermediates)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/ohlcflow/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own (Hadoop) file system; errors of the
    store itself are raised, not read as absence."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def materialize(df, eager: bool = True):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where one derived table feeds several branches of a plan whose
    column pruning would otherwise make Spark recompute it per branch (e.g.
    bars aggregated from raw trades). Unlike a cache, the written copy cuts
    the lineage and survives the loss of executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df, name: str):
    """``df`` as a compressed table in the shared folder; for large tables, which
    ``materialize`` writes uncompressed, and keeps the partitioning of."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def _with_conf(spark: SparkSession, values: dict):
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def no_shuffles_kept(spark: SparkSession):
    """Shuffle files of the queries that run here go as each ends, not when the
    driver's garbage happens to be collected; for many queries, each run once."""
    return _with_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def few_rows_at_a_time(spark: SparkSession):
    """Tables whose rows are megabytes each are read so here: a task would else
    hold thousands of rows at once."""
    return _with_conf(spark, {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"})
