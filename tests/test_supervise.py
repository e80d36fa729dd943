"""Supervised queries: restarts from the checkpoint, limits, the events table."""

from __future__ import annotations

import pytest

from ohlcflow.session import scratch_path
from ohlcflow.streaming import ingest as S
from ohlcflow.streaming.supervise import Supervisor


def starter(spark, name, source, out, fail):
    def write(batch, batch_id):
        if fail(batch_id):
            raise RuntimeError(f"lost {batch_id}")
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    stream = lambda: S.table_stream(spark, source, max_files_per_trigger=1)      # noqa: E731
    return lambda: S.start(stream(), name, spark, foreach_batch=write, out_path=out + "-query")[0]


def test_failed_query_goes_on_and_the_limit_holds(spark):
    source = scratch_path(spark, "src")
    spark.range(0, 30, 1, 3).write.parquet(source)
    outs = [scratch_path(spark, n) for n in ("a", "b", "c")]
    lost = []

    def twice(batch_id):
        if batch_id == 1 and len(lost) < 2:
            lost.append(batch_id)
            return True
        return False

    sup = Supervisor(spark, scratch_path(spark, "events"), max_restarts=2)
    assert sup.run({"a": starter(spark, "a", source, outs[0], twice),
                    "b": starter(spark, "b", source, outs[1], lambda b: False)}) == {"a": 3, "b": 1}
    for out in outs[:2]:
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(30))
    rows = sup.events().orderBy("at").collect()
    assert [r.event for r in rows if r["query"] == "a"] == ["started", "failed", "started", "failed", "started", "finished"]
    assert all("lost 1" in r.error for r in rows if r.event == "failed")
    with pytest.raises(Exception, match="lost 0"):
        sup.run({"c": starter(spark, "c", source, outs[2], lambda b: True), "d": starter(spark, "d", source, scratch_path(spark, "d"), lambda b: False)})
    assert not [q for q in spark.streams.active if q.name and q.name.startswith(("c_", "d_"))]
    assert sup.events().where("query = 'c' AND event = 'failed'").count() == 3
