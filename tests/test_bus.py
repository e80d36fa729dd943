"""The message log: offsets, atomic commits, replays, restarts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ohlcflow.session import scratch_path
from ohlcflow.sources import bus
from ohlcflow.streaming import ingest as S


def messages(spark, a, b, parts=3):
    return spark.range(a, b, 1, parts).select((F.col("id") % 3).cast("string").alias("symbol"), F.col("id").cast("string").alias("value"))


def test_offsets_have_no_gap_and_slices_are_exact(spark):
    topic = scratch_path(spark, "topic")
    for a, b in ((0, 70), (70, 71), (71, 71), (71, 200)):
        S.publish_bus(messages(spark, a, b), topic)
    rows = S.bus_table(spark, topic).collect()
    assert sorted(r.offset for r in rows) == list(range(200)) and sorted(int(r.value) for r in rows) == list(range(200))
    place = {r.offset: r.value for r in rows}
    for a, b in ((0, 0), (5, 71), (69, 72), (199, 200), (0, 200)):
        assert {r.offset: r.value for r in S.bus_table(spark, topic, a, b).collect()} == {k: place[k] for k in range(a, b)}
    with pytest.raises(Exception, match="ends at 200"):
        S.bus_table(spark, topic, 0, 201).collect()


def test_slices_across_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    os.makedirs(tmp_path / "data")
    t = pa.table({"symbol": ["s"] * 1000, "value": [str(i) for i in range(1000)]})
    pq.write_table(t, tmp_path / "data" / "x.parquet", row_group_size=70)
    for skip, n in ((0, 1000), (69, 2), (140, 70), (333, 500), (999, 1)):
        got = [r for b in bus._read(str(tmp_path), bus.Slice("x.parquet", skip, n, 5)) for r in b.to_pylist()]
        assert [int(r["value"]) for r in got] == list(range(skip, skip + n))
        assert [r["offset"] for r in got] == list(range(5, 5 + n))


def test_replayed_batch_is_committed_once(tmp_path):
    topic = bus.Topic(str(tmp_path))
    topic.commit([bus.Segment("a", 3)], "w", 0)
    bus.Topic(str(tmp_path)).commit([bus.Segment("b", 3)], "w", 0)      # the same batch once more
    topic.commit([bus.Segment("c", 2)], "w", 1)
    topic.commit([bus.Segment("d", 1)])                                # another writer between
    bus.Topic(str(tmp_path)).commit([bus.Segment("e", 2)], "w", 1)
    end = bus.Topic(str(tmp_path)).refresh()
    assert end.end == 6 and [s[0] for m in end.held for s in m["segments"]] == ["a", "c", "d"]


def test_two_writers_at_once_both_commit(tmp_path):
    one, two = bus.Topic(str(tmp_path)).refresh(), bus.Topic(str(tmp_path)).refresh()
    refresh, raced = one.refresh, []

    def late():                                  # the other commits between look and link
        refresh()
        if not raced:
            raced.append(1)
            two.commit([bus.Segment("b", 4)])
        return one

    one.refresh = late
    one.commit([bus.Segment("a", 3)])
    held = bus.Topic(str(tmp_path)).refresh().held
    assert [(m["first"], m["end"]) for m in held] == [(0, 4), (4, 7)]


def test_restart_goes_on_from_its_offset(spark):
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "bus-out")
    sizes = []

    def write(batch, batch_id):
        sizes.append(batch.count())
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for a, b in ((0, 100), (100, 250), (250, 250)):
        S.publish_bus(messages(spark, a, b), topic)
        q, _ = S.start(S.bus_stream(spark, topic, 40, "g"), "bus", spark, foreach_batch=write, processing_time="0 seconds",
                       available_now=False, out_path=topic + "-query")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    assert max(sizes) == 40 and sum(sizes) == 250
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == list(range(250))


def test_failed_batch_is_run_again_whole(spark):
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "bus-out")
    S.publish_bus(messages(spark, 0, 90), topic)
    failed = []

    def write(batch, batch_id):
        if batch_id == 1 and not failed:
            failed.append(1)
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for k in range(2):
        q, _ = S.start(S.bus_stream(spark, topic, 40, "g"), "bus", spark, foreach_batch=write, processing_time="0 seconds",
                       available_now=False, out_path=topic + "-query")
        try:
            q.processAllAvailable()
            assert k
        except Exception:
            assert not k
        finally:
            q.stop()
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == list(range(90))


def test_options_are_checked():
    with pytest.raises(ValueError, match="group"):
        bus._StreamReader("/none", {"maxMessagesPerTrigger": "5"})
    with pytest.raises(ValueError, match="writer"):
        bus._StreamWriter("/none", {})
    with pytest.raises(ValueError, match="mounted"):
        bus.local_path("hdfs://host/topic")
    assert bus.local_path("file:/a/b") == bus.local_path("/a/b") == "/a/b"
