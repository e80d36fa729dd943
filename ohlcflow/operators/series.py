"""Ordered work on long series without one task per symbol.

A window ``partitionBy(symbol).orderBy(ts)`` sends a whole symbol to one
task; with a handful of symbols (or one symbol holding a third of all rows)
that is the bottleneck. Ordered operators here run in two steps instead:

1. ``index_series`` numbers the rows of each key: rows are first numbered
   inside (key, time bucket) partitions, the per-bucket counts (one row per
   bucket, so the table grows with the time span, not with the data) give
   each bucket its offset, and ``_g = offset + local number``. ``_n`` is the
   row count of the key.
2. ``chunked`` cuts every key into chunks of ``chunk_rows`` consecutive rows
   and copies the few rows a window needs from the neighbouring chunk (the
   halo). Window functions then run per (key, chunk): equal-sized, skew-free
   partitions. Rows are kept only in their own chunk afterwards.

The result is exact: no row is dropped or sampled, every window sees the same
neighbours it would see in one global window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default rows per chunk. Large enough that the halo (a window length) is a
# small fraction, small enough that a chunk's sort fits in task memory.
DEFAULT_CHUNK_ROWS = 1 << 17


def _cols(xs) -> list:
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def index_series(df: DataFrame, keys: Sequence[str] = ("symbol",),
                 order: Sequence[str] = ("ts",), bucket: str = "day") -> DataFrame:
    """Add ``_g`` (0-based row position within ``keys`` by ``order``) and
    ``_n`` (rows within ``keys``).

    ``bucket`` is a ``date_trunc`` unit applied to the first order column; it
    must be coarse enough that per-key bucket counts stay a small table and
    fine enough that one (key, bucket) sorts in one task. For bars the number
    of rows per bucket is bounded by bucket width / bar width: a day for hours
    and minutes, a year for daily bars. The input is read twice; pass bars
    that are stored (``session.materialize``), not derived from trades.
    """
    keys, order = _cols(keys), _cols(order)
    bkt = F.date_trunc(bucket, F.col(order[0]))
    d = df.withColumn("_bkt", bkt)
    w_local = Window.partitionBy(*keys, "_bkt").orderBy(*order)
    d = d.withColumn("_rib", F.row_number().over(w_local) - 1)
    # One row per (key, bucket): a hash aggregate over the grouping columns,
    # which is cheaper than sharing the numbered rows.
    counts = d.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    w_key = Window.partitionBy(*keys).orderBy("_bkt")
    offsets = counts.select(
        *keys, "_bkt",
        F.coalesce(F.sum("_cnt").over(w_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*keys)).alias("_n"),
    )
    # The offsets table is small but grows with keys x buckets, so no
    # broadcast hint: AQE broadcasts it when its measured size is below the
    # threshold and keeps the shuffle join beyond it.
    out = d.join(offsets, [*keys, "_bkt"], "inner")
    return out.withColumn("_g", F.col("_off") + F.col("_rib")).drop("_off", "_rib", "_bkt")


def chunked(indexed: DataFrame, keys: Sequence[str] = ("symbol",), back: int = 0,
            fwd: int = 0, chunk_rows: int = DEFAULT_CHUNK_ROWS):
    """Lay an indexed series out in (key, chunk) partitions with halos.

    Returns ``(frame, window)``: ``frame`` holds each row once in its own chunk
    plus halo copies (the last ``back`` rows of the previous chunk, the first
    ``fwd`` rows of the next), ``window`` is ``partitionBy(keys, _chunk)
    .orderBy(_g)``. Compute window columns over ``window`` and finish with
    ``own_rows(frame)``.
    """
    keys = _cols(keys)
    if back > chunk_rows or fwd > chunk_rows:
        raise ValueError("halo longer than a chunk; raise chunk_rows")
    own = F.floor(F.col("_g") / F.lit(chunk_rows))
    pos = F.col("_g") - own * F.lit(chunk_rows)
    targets = F.array(own)
    if back > 0:
        targets = F.concat(targets, F.when(pos >= chunk_rows - back, F.array(own + 1))
                           .otherwise(F.array().cast("array<bigint>")))
    if fwd > 0:
        targets = F.concat(targets, F.when((pos < fwd) & (own > 0), F.array(own - 1))
                           .otherwise(F.array().cast("array<bigint>")))
    frame = indexed.withColumn("_own", own).withColumn("_chunk", F.explode(targets))
    window = Window.partitionBy(*keys, "_chunk").orderBy("_g")
    return frame, window


def own_rows(frame: DataFrame) -> DataFrame:
    """Drop halo copies after the window pass."""
    return frame.where(F.col("_chunk") == F.col("_own")).drop("_chunk", "_own")


def ensure_index(df: DataFrame, keys: Sequence[str] = ("symbol",), bucket: str = "day") -> DataFrame:
    """Reuse ``_g``/``_n`` when a caller already indexed the series."""
    if "_g" in df.columns and "_n" in df.columns:
        return df
    return index_series(df, keys, ["ts"], bucket)
