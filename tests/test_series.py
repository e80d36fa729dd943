"""The chunk + halo layout is exact: same results as one global window,
whatever the chunk size, including a symbol holding most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, have_testdata
from ohlcflow import tables
from ohlcflow.operators import bars as B
from ohlcflow.operators import features as X
from ohlcflow.operators import lstm as L
from ohlcflow.operators.series import index_series

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver tables missing")


@pytest.fixture(scope="module")
def skewed(spark):
    """15-minute bars where one symbol holds more than a third of the rows."""
    t = tables.ticks(spark, SF_SMALL)
    hot = t.withColumn("symbol", F.when(F.col("symbol").isin("view", "click"), F.lit("HOT")).otherwise(F.col("symbol")))
    return B.ticks_to_bars(hot, "15 minutes").cache()


def test_skew_fixture(skewed):
    n = skewed.count()
    assert skewed.where("symbol = 'HOT'").count() > n / 3


def test_index_equals_global_row_number(skewed):
    got = index_series(skewed, ["symbol"], ["ts"], "hour").select("symbol", "ts", "_g", "_n")
    w = Window.partitionBy("symbol").orderBy("ts")
    exp = skewed.select("symbol", "ts", (F.row_number().over(w) - 1).alias("_g"),
                        F.count(F.lit(1)).over(Window.partitionBy("symbol")).alias("_n"))
    assert sorted(got.collect()) == sorted(exp.collect())


@pytest.mark.parametrize("chunk", [3, 7, 50])
def test_windows_invariant(skewed, chunk):
    base = X.sequence_windows(skewed, ["close", "volume"], 5, chunk_rows=1 << 17)
    small = X.sequence_windows(skewed, ["close", "volume"], 5, chunk_rows=max(chunk, 5))
    assert sorted(base.collect()) == sorted(small.collect())
    lb = X.lag_features(skewed, "close", 4)
    ls = X.lag_features(skewed, "close", 4, chunk_rows=chunk)
    assert sorted(lb.collect()) == sorted(ls.collect())
    tb = X.lead_target(skewed)
    ts = X.lead_target(skewed, chunk_rows=chunk)
    assert sorted(tb.collect()) == sorted(ts.collect())


def test_lead_target_equals_global_lead(skewed):
    w = Window.partitionBy("symbol").orderBy("ts")
    exp = skewed.select("symbol", "ts", F.lead("close").over(w).alias("t"))
    exp = exp.withColumn("t", F.coalesce("t", F.avg("t").over(Window.partitionBy("symbol"))))
    got = X.lead_target(skewed, chunk_rows=5).select("symbol", "ts", F.col("target").alias("t"))
    a = {(r.symbol, r.ts): r.t for r in exp.collect()}
    b = {(r.symbol, r.ts): r.t for r in got.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_bulk_scoring_equals_fold(skewed):
    sc = X.apply_minmax(skewed, X.fit_minmax(skewed, ["close", "volume"]), ["close", "volume"], suffix="_s")
    th = L.theta_from_gates(L.FIXED_TEST_WEIGHTS)
    bulk = L.score_bulk(sc, ["close_s", "volume_s"], 6, th, chunk_rows=20)
    fold = X.trailing_windows(sc, ["close_s", "volume_s"], 6, exclude_current=True) \
        .select("symbol", "ts", L.lstm_fold("xs", L.FIXED_TEST_WEIGHTS, 2).alias("h"))
    a = {(r.symbol, r.ts): r.h for r in bulk.collect()}
    b = {(r.symbol, r.ts): r.h for r in fold.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_retention_and_split_match_global(skewed):
    w = Window.partitionBy("symbol").orderBy(F.desc("ts"))
    exp = skewed.withColumn("rn", F.row_number().over(w)).where("rn <= 10").drop("rn")
    assert sorted(B.rolling_retention(skewed, 10).collect()) == sorted(exp.collect())


def test_kept_index_matches_fresh_index(skewed):
    kept = B.rolling_retention(skewed, 40, keep_index=True)
    fresh = index_series(B.rolling_retention(skewed, 40), ["symbol"], ["ts"], "hour")
    a = sorted((r.symbol, r.ts, r._g, r._n) for r in kept.select("symbol", "ts", "_g", "_n").collect())
    b = sorted((r.symbol, r.ts, r._g, r._n) for r in fresh.select("symbol", "ts", "_g", "_n").collect())
    assert a == b
    lt = X.lead_target(skewed, keep_index=True, chunk_rows=7)
    sp = B.chronological_split(lt, keep_index=True)
    ref = B.chronological_split(skewed).select("symbol", "ts", "split")
    assert sorted(sp.select("symbol", "ts", "split").collect()) == sorted(ref.collect())
