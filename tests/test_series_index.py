"""The stored index equals a fresh one after every batch, late and corrected
rows and crashes included, and a batch writes its own buckets only."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ohlcflow.operators import bars as B
from ohlcflow.operators import features as X
from ohlcflow.operators.series import index_series
from ohlcflow.session import scratch_path
from ohlcflow.streaming.series_index import SeriesIndex

SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("ts", T.TimestampType()),
                       T.StructField("close", T.DoubleType())])
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(hour):
    return START + dt.timedelta(hours=hour)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def fresh(spark, rows):
    got = index_series(frame(spark, list(rows.values())), ["symbol"], ["ts"]).collect()
    return sorted((r.symbol, r.ts, r.close, r["_g"], r["_n"]) for r in got)


def stored(index, manifest=None):
    return sorted((r.symbol, r.ts, r.close, r["_g"], r["_n"]) for r in index.read(manifest).collect())


def batches():
    """Days in order, then late rows in old days, corrected rows, nothing."""
    rng = random.Random(3)
    days = [[(s, at(24 * d + h), float(rng.random())) for s, hours in (("hot", range(24)), ("thin", (3 * d % 24,)))
             for h in hours if (d, h) != (1, 5)] for d in range(4)]
    late = [("hot", at(24 + 5), 9.0), ("new", at(30), 1.0), ("thin", at(-30), 2.0)]
    fixed = [("hot", at(2), -1.0), ("hot", at(2), -1.0), ("hot", at(97), 4.0)]
    return [*days, late, fixed, [], [(None, at(1), 1.0), ("hot", None, 1.0)]]


def test_equals_a_fresh_index_after_every_batch(spark):
    index = SeriesIndex(spark, scratch_path(spark, "index"), SCHEMA, max_deltas=3)
    rows = {}
    for k, batch in enumerate(batches()):
        before = index.latest()
        done = index.append(frame(spark, batch), k)
        rows.update({r[:2]: r for r in batch if r[0] and r[1]})
        assert stored(index) == fresh(spark, rows)
        moved = {b for b, p in done["buckets"].items() if before["buckets"].get(b) != p}
        touched = {int(r[1].replace(hour=0).timestamp() * 1e6) for r in batch if r[0] and r[1]}
        assert {int(b) for b in moved} == touched
        assert len(done["counts"]) <= 4
        assert index.append(frame(spark, [("hot", at(999), 0.0)]), k) == done           # a replay changes nothing
    assert stored(SeriesIndex(spark, index.root, SCHEMA)) == fresh(spark, rows)         # opened anew
    empty = SeriesIndex(spark, scratch_path(spark, "index"), SCHEMA)
    assert empty.read().count() == empty.newest(3).count() == 0


def test_crash_before_the_commit_and_replay(spark, monkeypatch):
    index = SeriesIndex(spark, scratch_path(spark, "index"), SCHEMA)
    index.append(frame(spark, batches()[0]), 0)
    before = stored(index)

    def crash(*args, **kw):
        raise RuntimeError("lost")
    for step in ("_rewrite", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(index, step, crash)
            with pytest.raises(RuntimeError):
                index.append(frame(spark, batches()[4]), 1)
        assert stored(index) == before
    index.append(frame(spark, batches()[4]), 1)
    rows = {r[:2]: r for b in (0, 4) for r in batches()[b]}
    assert stored(index) == fresh(spark, rows)
    live = {p.split("/")[1] for v in index.versions() for p in index.manifest(v)["buckets"].values()}
    assert set(index._list("data")) == live                                             # what crashed is cleared away


def test_versions_are_whole_and_old_ones_go(spark):
    index = SeriesIndex(spark, scratch_path(spark, "index"), SCHEMA, max_deltas=2, keep_versions=3)
    rows, seen = {}, []
    for k, batch in enumerate(batches()[:5]):
        rows.update({r[:2]: r for r in batch})
        seen.append((index.append(frame(spark, batch), k), fresh(spark, rows)))
    assert len(index.versions()) == 3
    for manifest, want in seen[-2:]:
        assert stored(index, manifest) == want


def test_newest_reads_the_last_buckets_only(spark):
    index = SeriesIndex(spark, scratch_path(spark, "index"), SCHEMA)
    rows = {}
    for k, batch in enumerate(batches()[:4]):
        batch = [r for r in batch if r[0] == "hot"]
        index.append(frame(spark, batch), k)
        rows.update({r[:2]: r for r in batch})
    got = index.newest(30)
    read, whole = ([f for f in df.inputFiles() if "/rows/" in f] for df in (got, index.read()))
    assert (len(read), len(whole)) == (2, 4)                                            # folders of one file each
    want = B.rolling_retention(frame(spark, list(rows.values())), 30)
    assert sorted(r.ts for r in got.collect()) == sorted(r.ts for r in want.collect())
    assert [d.day for d in index.starts()] == [1, 2, 3, 4]


def test_operators_take_the_stored_numbers(spark, monkeypatch):
    """Windows and splits over the stored index equal those over a fresh one,
    and number nothing."""
    index = SeriesIndex(spark, scratch_path(spark, "index"), SCHEMA)
    for k, batch in enumerate(batches()[:5]):
        index.append(frame(spark, batch), k)
    plain = index.read().drop("_g", "_n")
    want = [sorted(map(str, X.sequence_windows(plain, ["close"], 4).select("symbol", "win_id", "xs").collect())),
            sorted(map(str, B.chronological_split(plain).select("symbol", "ts", "split").collect()))]
    monkeypatch.setattr("ohlcflow.operators.series.index_series", None)
    got = [sorted(map(str, X.sequence_windows(index.read(), ["close"], 4).select("symbol", "win_id", "xs").collect())),
           sorted(map(str, B.chronological_split(index.read()).select("symbol", "ts", "split").collect()))]
    assert got == want and all(want)
