"""Bar operators: resampling (R1), projections (P*), set operations (U*),
ordering and limits (L*), and splits (D*)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import ensure_index


# ---------------------------------------------------------------- R1 resample

def ticks_to_bars(ticks: DataFrame, width: str = "1 hour", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """R1 on trades (symbol, ts, seq, price, size): first/max/min/last price,
    summed size, trade count and size-weighted price per ``width`` bucket.

    ``seq`` breaks ties between trades of the same instant. Every aggregate is
    partial-aggregatable (min_by/max_by keep one candidate), so the shuffle
    carries one partial row per (map task, symbol, bucket), whatever the skew.
    """
    keys = list(keys)
    order = F.struct("ts", "seq")
    # Grouping by the window struct (not its start) keeps the event-time
    # watermark on the key, so the same code closes windows on a stream.
    return (ticks
            .groupBy(*keys, F.window("ts", width).alias("_w"))
            .agg(F.min_by("price", order).alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", order).alias("close"),
                 F.sum("size").alias("volume"),
                 F.count(F.lit(1)).alias("trade_count"),
                 F.try_divide(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap"))
            .select(*keys, F.col("_w.start").alias("ts"), "open", "high", "low", "close", "volume",
                    "trade_count", "vwap"))


def resample_bars(bars: DataFrame, width: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """R1 on bars: coarser bars from finer ones. vwap is volume-weighted."""
    keys = list(keys)
    return (bars
            .groupBy(*keys, F.window("ts", width).alias("_w"))
            .agg(F.min_by("open", "ts").alias("open"),
                 F.max("high").alias("high"),
                 F.min("low").alias("low"),
                 F.max_by("close", "ts").alias("close"),
                 F.sum("volume").alias("volume"),
                 F.sum("trade_count").alias("trade_count"),
                 F.try_divide(F.sum(F.col("vwap") * F.col("volume")), F.sum("volume")).alias("vwap"))
            .select(*keys, F.col("_w.start").alias("ts"), "open", "high", "low", "close", "volume",
                    "trade_count", "vwap"))


def bars_between(bars: DataFrame, symbol: str, start, end, width: str | None = None) -> DataFrame:
    """Bars of one symbol in [start, end), optionally re-bucketed.

    The filter is on plain columns, so it reaches the Parquet scan
    (PushedFilters) and prunes partitions when bars are stored by symbol/date.
    """
    out = bars.where((F.col("symbol") == F.lit(symbol))
                     & (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
                     & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
    return resample_bars(out, width) if width else out


# ------------------------------------------------------------- P projections

def project(df: DataFrame, mapping: dict) -> DataFrame:
    """Select and rename in one step, ``{new_name: old_name_or_Column}``."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """P2."""
    return df.drop(*names)


def column_at(df: DataFrame, i: int) -> DataFrame:
    """One column by position (``iloc[:, i:i+1]``)."""
    return df.select(df.columns[i])


def is_empty(df: DataFrame) -> bool:
    """Empty-batch guard; stops at the first row instead of counting."""
    return df.isEmpty()


def newer_than_seen(bars: DataFrame, seen: DataFrame) -> DataFrame:
    """P5: bars newer than the latest bar already seen for their symbol.

    ``seen`` is reduced to one row per symbol before the join; symbols never
    seen pass whole.
    """
    last = seen.groupBy("symbol").agg(F.max("ts").alias("_seen_ts"))
    return (bars.join(last, "symbol", "left")
            .where(F.col("_seen_ts").isNull() | (F.col("ts") > F.col("_seen_ts")))
            .drop("_seen_ts"))


def label_index(df: DataFrame, label: str = "label", out: str = "label_index"):
    """Category codes in sorted label order (``StringIndexer`` alphabetAsc)."""
    from pyspark.ml.feature import StringIndexer
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df)
    return model.transform(df).withColumn(out, F.col(out).cast("int")), model


def schema_listing(df: DataFrame):
    """(column, type) pairs."""
    return list(df.dtypes)


# ------------------------------------------------------------- U set ops

def append_bars(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Append by column name (order-safe)."""
    return stored.unionByName(new.select(*stored.columns))


def concat_tagged(train: DataFrame, test: DataFrame, tag: str = "split") -> DataFrame:
    """Concatenate train and test with a split tag."""
    return (train.withColumn(tag, F.lit("train"))
            .unionByName(test.withColumn(tag, F.lit("test"))))


# ------------------------------------------------------------- L order/limit

def latest_bar(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """L1: newest bar per symbol by timestamp, without sorting the data."""
    keys = list(keys)
    rest = [c for c in bars.columns if c not in keys]
    return (bars.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), "ts").alias("_b"))
            .select(*keys, "_b.*"))


def rolling_retention(bars: DataFrame, capacity: int, keys: Sequence[str] = ("symbol",),
                      bucket: str = "day", keep_index: bool = False) -> DataFrame:
    """L2: keep the newest ``capacity`` bars of each symbol.

    With ``keep_index`` the numbering is re-based to the kept rows
    (``_g - (n - kept)``, ``_n = kept``) for the next ordered operator.
    """
    idx = ensure_index(bars, keys, bucket)
    dropped = F.greatest(F.col("_n") - F.lit(capacity), F.lit(0))
    out = idx.where(F.col("_g") >= dropped)
    if not keep_index:
        return out.drop("_g", "_n")
    return (out.withColumn("_g", F.col("_g") - dropped)
            .withColumn("_n", F.least(F.col("_n"), F.lit(capacity)).cast("bigint")))


def tail_with_context(tagged: DataFrame, context: int, keys: Sequence[str] = ("symbol",),
                      tag: str = "split", bucket: str = "day") -> DataFrame:
    """L3: all test rows plus the last ``context`` training rows before them.
    A numbered input (``_g``/``_n``) is not numbered again."""
    idx = ensure_index(tagged, keys, bucket)
    # per-symbol test counts come from a small aggregate, not a whole-symbol window
    counts = tagged.groupBy(*keys).agg(F.sum(F.when(F.col(tag) == "test", 1).otherwise(0)).alias("_nt"))
    return (idx.join(counts, list(keys))
            .where(F.col("_g") >= F.col("_n") - F.col("_nt") - F.lit(context))
            .drop("_g", "_n", "_nt"))


def head(df: DataFrame, n: int, order: Sequence[str] = ("ts", "symbol")) -> DataFrame:
    """L4: first ``n`` rows in order (top-k per partition, then one merge)."""
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------- D splits

def chronological_split(bars: DataFrame, test_fraction: float = 0.2,
                        keys: Sequence[str] = ("symbol",), bucket: str = "day",
                        keep_index: bool = False) -> DataFrame:
    """Tag the newest ``ceil(test_fraction * n)`` rows of each key as test.

    Same counts as an unshuffled 80/20 hold-out; the rest is train. An input
    that is already numbered (``_g``/``_n``) is not numbered again;
    ``keep_index`` keeps the numbering for the next ordered operator.
    """
    idx = ensure_index(bars, keys, bucket)
    n_test = F.ceil(F.col("_n") * F.lit(test_fraction))
    out = idx.withColumn("split", F.when(F.col("_g") >= F.col("_n") - n_test, F.lit("test"))
                         .otherwise(F.lit("train")))
    return out if keep_index else out.drop("_g", "_n")


def hash_bucket(id_col: str, seed: int = 1234):
    """Stable 0..99 bucket of an id: first 32 bits of md5(id || seed)."""
    h = F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed)))), 1, 8)
    return (F.conv(h, 16, 10).cast("bigint") % F.lit(100)).cast("int")


def random_split(df: DataFrame, id_col: str, train_percent: int = 80, seed: int = 1234) -> DataFrame:
    """Seeded, partitioning-independent train/test tag by id hash."""
    return df.withColumn("split", F.when(hash_bucket(id_col, seed) < train_percent, F.lit("train"))
                         .otherwise(F.lit("test")))
