"""Life cycle of several streaming queries (ST7).

``Supervisor`` starts named queries and waits on all of them together. One that
fails is started again and goes on from its own checkpoint, the others run on;
after ``max_restarts`` failures of a query the error is raised and the rest are
stopped. Every start, failure and end is a row of a table in the shared folder
with the run's last batch and its input rows, written when it happens.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

EVENT = ("at timestamp, query string, run int, event string, last_batch long, input_rows long, error string")


class Supervisor:
    def __init__(self, spark: SparkSession, log_path: str, max_restarts: int = 3, poll_s: int = 1):
        self.spark, self.log_path = spark, log_path
        self.max_restarts, self.poll_s = int(max_restarts), int(poll_s)

    def _note(self, name: str, run: int, event: str, query: StreamingQuery | None = None, error: str | None = None) -> None:
        progress = query.recentProgress if query is not None else []
        row = (dt.datetime.now(dt.timezone.utc), name, run, event, max((p["batchId"] for p in progress), default=None),
               sum(p["numInputRows"] for p in progress), error)
        self.spark.createDataFrame([row], EVENT).coalesce(1).write.mode("append").parquet(self.log_path)

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENT).parquet(self.log_path)

    def run(self, starts: dict[str, Callable[[], StreamingQuery]]) -> dict[str, int]:
        """Run the queries to their end; returns the runs that each took."""
        runs = {name: 0 for name in starts}
        live: dict[str, StreamingQuery] = {}

        def begin(name):
            live[name] = starts[name]()
            self._note(name, runs[name], "started")

        try:
            for name in starts:
                begin(name)
            while live:
                # A termination that came before this call returns at once; queries
                # of others do, too, so the state of each own one is what counts.
                self.spark.streams.resetTerminated()
                if all(q.isActive for q in live.values()):
                    try:
                        self.spark.streams.awaitAnyTermination(self.poll_s)
                    except Exception:            # of whichever query failed; read below from that query itself
                        pass
                for name, q in list(live.items()):
                    if q.isActive:
                        continue
                    del live[name]
                    error = q.exception()
                    if error is None:
                        self._note(name, runs[name], "finished", q)
                        continue
                    self._note(name, runs[name], "failed", q, str(error)[:2000])
                    runs[name] += 1
                    if runs[name] > self.max_restarts:
                        raise error
                    begin(name)
        finally:
            for q in live.values():
                q.stop()
        return {name: n + 1 for name, n in runs.items()}
