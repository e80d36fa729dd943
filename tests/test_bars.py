"""Sources, resampling, splits and windows against FIXTURES G1, G3-G6."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import fixture_path
from ohlcflow.operators import bars as B
from ohlcflow.operators import features as X
from ohlcflow.sources import codec, files


@pytest.fixture(scope="module")
def bars5(spark):
    return files.read_bars_csv(spark, fixture_path("bars_5min.csv"), "AAPL").cache()


def test_g3_stream_csv(bars5):
    r = bars5.agg(F.count(F.lit(1)).alias("n"), F.min("close").alias("lo"), F.max("close").alias("hi"),
                  F.sum("volume").alias("v"), F.sum("trade_count").alias("t")).first()
    assert (r.n, r.lo, r.hi, r.v, r.t) == (288, 118.5, 151.78, 114766506, 787827)
    last = B.latest_bar(bars5).first()
    assert last.ts == dt.datetime(2021, 12, 1, 10, 35) and last.close == 118.5


def test_g3_targets_and_windows(bars5):
    lt = X.lead_target(bars5)
    assert lt.where(F.col("ts") == dt.datetime(2021, 12, 1, 10, 35)).first().target == pytest.approx(149.884751, abs=1e-6)
    assert X.sequence_windows(lt, ["close"], 72, target="target").count() == 216
    assert X.sequence_windows(lt, ["close"], 72, include_last=True).count() == 217
    # the halo layout gives the same windows whatever the chunk size
    a = X.sequence_windows(lt, ["close", "volume"], 72, target="target", chunk_rows=100).orderBy("win_id").collect()
    b = X.sequence_windows(lt, ["close", "volume"], 72, target="target").orderBy("win_id").collect()
    assert a == b


def test_g3_split(bars5):
    sp = B.chronological_split(bars5)
    test = sp.where(F.col("split") == "test")
    assert test.count() == 58
    assert test.agg(F.min("ts")).first()[0] == dt.datetime(2021, 11, 16, 18, 20)


def test_g3_resample(bars5):
    assert B.resample_bars(bars5, "15 minutes").count() == 102
    assert B.resample_bars(bars5, "1 hour").count() == 27
    days = [r.volume for r in B.resample_bars(bars5, "1 day").orderBy("ts").collect()]
    assert days == [55827709, 58936039, 2758]


def test_g3_first_row_scaled(bars5):
    cols = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]
    s = X.apply_minmax(bars5, X.fit_minmax(bars5, cols), cols, suffix="_s")
    first = s.orderBy("ts").first()
    exp = [0.971755, 0.968844, 0.979916, 0.970853, 0.002479, 0.020035, 0.973956]
    assert [round(first[c + "_s"], 6) for c in cols] == pytest.approx(exp, abs=1e-6)


def test_g1_resample_15_minutes(spark):
    raw = files.read_bars_json(spark, fixture_path("bars_dummy.jsonl"), "AAPL")
    got = B.resample_bars(raw, "15 minutes").orderBy("ts").collect()
    exp = files.read_bars_csv(spark, fixture_path("bars_15min_expected.csv"), "AAPL").orderBy("ts").collect()
    assert len(got) == len(exp) == 15
    for g, e in zip(got, exp):
        assert g.ts == e.ts
        for c in ["open", "high", "low", "close", "vwap"]:
            assert g[c] == pytest.approx(e[c], abs=2e-6), (g.ts, c)
        assert (g.volume, g.trade_count) == (e.volume, e.trade_count)


def test_g4_daily_csv(spark):
    d = files.read_daily_csv(spark, fixture_path("daily_prices.csv"), "GOOG")
    r = d.agg(F.count(F.lit(1)), F.sum("volume"), F.min("open"), F.max("open"), F.sum("open")).first()
    assert (r[0], r[1], r[2], r[3]) == (20, 33197900, 778.81, 837.81)
    assert r[4] == pytest.approx(16150.52, abs=1e-6)
    assert d.orderBy("date").first().date == dt.date(2017, 1, 3)


def test_g5_quoted_numbers(spark):
    df = spark.createDataFrame([('{"Close":"118.9"}',)], "value string")
    strict = df.select(F.from_json("value", "Close double").alias("p")).first().p.Close
    assert strict is None
    bars = codec.decode_bars(df, symbol="AAPL").first()
    assert bars.close == 118.9


def test_g6_frames(spark):
    msgs = [{"T": "b", "S": "AAPL", "t": "2021-11-15T14:00:00Z", "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5,
             "v": 10, "n": 2, "vw": 1.2},
            {"T": "t", "S": "AAPL", "t": "2021-11-15T14:00:01Z", "p": 1.5},
            {"T": "b", "S": "AAPL", "t": "2021-11-15T14:05:00Z", "o": "1.5", "h": "2.5", "l": "1.0", "c": "2.0",
             "v": "20", "n": "3", "vw": "1.7"}]
    df = spark.createDataFrame([(json.dumps(msgs),)], "value string")
    out = codec.decode_frames(df).orderBy("ts").collect()
    assert len(out) == 2
    assert out[0].close == 1.5 and out[1].close == 2.0 and out[1].volume == 20


def test_wire_roundtrip(spark, bars5):
    wire = codec.encode_bars_wire(bars5, quote_numbers=True, keep=["symbol"])
    back = codec.flatten_bar(wire.select("symbol", codec.decode_bar_struct(F.col("value")).alias("p")), "p",
                             F.col("symbol"))
    key = ["ts"]
    assert back.orderBy(*key).collect() == bars5.orderBy(*key).collect()


def test_csv_sink_roundtrip(spark, bars5, tmp_path):
    path = str(tmp_path / "bars")
    files.write_bars_csv(bars5, path)
    back = files.read_bars_csv(spark, path, "AAPL")
    assert back.orderBy("ts").collect() == bars5.orderBy("ts").collect()


def test_edge_cases(spark):
    rows = [("A", dt.datetime(2024, 1, 1, h), 1.0, 1.0, 1.0, 5.0, 10, 1, 5.0) for h in range(6)] + \
           [("B", dt.datetime(2024, 1, 1, h), 1.0, 2.0, 0.5, float(h), 10 + h, 1, 1.0) for h in range(3)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double, low double, "
                                     "close double, volume bigint, trade_count bigint, vwap double")
    s = X.apply_minmax(df, X.fit_minmax(df, ["close"]), ["close"], suffix="_s")
    assert {r.close_s for r in s.where("symbol = 'A'").collect()} == {0.0}          # constant column
    w = X.sequence_windows(df, ["close"], 4)
    assert w.where("symbol = 'B'").count() == 0                                     # shorter than b
    assert w.where("symbol = 'A'").count() == 2
    assert B.rolling_retention(df, 2).groupBy("symbol").count().where("count != 2").count() == 0


def test_random_split_stable(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.split for r in B.random_split(df.repartition(7), "doc_id").collect()}
    b = {r.doc_id: r.split for r in B.random_split(df.coalesce(1), "doc_id").collect()}
    assert a == b and 0.7 < sum(v == "train" for v in a.values()) / 500 < 0.9


def test_projection_helpers_and_events(spark, bars5):
    p = B.project(bars5, {"Date": "ts", "Close": "close"})
    assert p.columns == ["Date", "Close"]
    assert B.drop_columns(bars5, "ts").columns == [c for c in bars5.columns if c != "ts"]
    assert B.column_at(bars5, 2).columns == ["open"]
    assert ("close", "double") in B.schema_listing(bars5)
    assert not B.is_empty(bars5) and B.is_empty(bars5.limit(0))
    ev = bars5.limit(1).select(codec.prediction_event("close", "open").alias("v")).first().v
    assert json.loads(ev) == {"currentPrice": 150.81, "predictedPrice": 150.84}


def test_labelled_csv(spark, tmp_path):
    p = tmp_path / "docs.csv"
    p.write_text('author,text\nHAMILTON,"first line\nsecond line"\nMADISON,"other, text"\n')
    from ohlcflow.sources.files import read_labelled_csv
    d = read_labelled_csv(spark, str(p)).orderBy("label").collect()
    assert [r.label for r in d] == ["HAMILTON", "MADISON"] and d[0].text == "first line\nsecond line"


def test_parquet_store_prunes_partitions(spark, bars5, tmp_path):
    path = str(tmp_path / "store")
    files.write_bars_parquet(bars5, path, mode="overwrite")
    stored = spark.read.parquet(path)
    q = B.bars_between(stored, "AAPL", "2021-11-16 00:00:00", "2021-11-17 00:00:00")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "(symbol" in plan
    assert "PushedFilters: [IsNotNull(ts)" in plan
    exp = bars5.where((F.col("ts") >= dt.datetime(2021, 11, 16)) & (F.col("ts") < dt.datetime(2021, 11, 17)))
    assert q.count() == exp.count() > 0


def test_bar_time_fractions(spark):
    from ohlcflow.functions.scalar import parse_bar_time
    texts = ["2021-11-15 13:55:00+00:00", "2021-11-15T13:55:00Z", "2021-11-15T13:55:00.000Z",
             "2021-11-15 13:55:00.5+00:00", "2021-11-15T13:55:00.123456Z", "2021-11-15T15:55:00.123456789+02:00",
             "2021-11-15 13:55:00", "2021-11-15 13:55:00.25", "13:55", "", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r.u for r in d.select("i", F.unix_micros(parse_bar_time(F.col("s"))).alias("u")).orderBy("i").collect()]
    t0 = 1636984500000000
    assert got == [t0, t0, t0, t0 + 500000, t0 + 123456, t0 + 123456, t0, t0 + 250000, None, None, None]
