"""Headline benchmark: runs the engine's main operators on $BENCH_SF_DIR
(default /root/testdata/sf0.1) with local[$BENCH_CPUS] and prints one JSON
line. Every query is executed in full through the ``noop`` sink (no collect
to the driver). Each query runs $BENCH_RUNS times (default 2); the reported
time is the best run (warm code generation and Python workers), the first
(cold) runs are listed under ``cold``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ohlcflow import tables  # noqa: E402
from ohlcflow.operators import bars as B  # noqa: E402
from ohlcflow.operators import features as X  # noqa: E402
from ohlcflow.operators import lstm as L  # noqa: E402
from ohlcflow.plans import authorship as AU  # noqa: E402
from ohlcflow.plans import forecast  # noqa: E402
from ohlcflow.plans import training as TR  # noqa: E402
from ohlcflow.session import get_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = max(1, int(os.environ.get("BENCH_RUNS", "2")))


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = get_session(f"local[{CPUS}]", 2 * CPUS, app="ohlcflow-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g")})
    from ohlcflow.session import shared_dir
    shared_dir(spark)
    ticks = tables.ticks(spark, SF_DIR)
    bars5 = lambda: B.ticks_to_bars(ticks, "5 minutes")
    hourly = lambda: B.ticks_to_bars(ticks, "1 hour")
    theta = L.theta_from_gates(L.FIXED_TEST_WEIGHTS)

    def m1_fold():
        sc = forecast.scaled_bars(bars5())
        w = X.trailing_windows(sc, ["close_s", "volume_s"], 72, exclude_current=True)
        return w.select("symbol", "ts", L.lstm_fold("xs", L.FIXED_TEST_WEIGHTS, 2).alias("h"))

    def m2_bulk():
        sc = forecast.scaled_bars(bars5())
        return L.score_bulk(sc, ["close_s", "volume_s"], 72, theta, exclude_current=True)

    def m6_epoch():
        return TR.train_pooled(spark, bars5(), b=24, epochs=1)

    def st5_stream():
        from ohlcflow.plans.q_stream import q_stream_scores
        return q_stream_scores(spark, SF_DIR)

    def t6():
        return AU.vectorize(AU.split_documents(spark, SF_DIR), **AU.VARIANTS["top1000"]).weights

    def t8():
        return AU.naive_bayes(AU.vectorize(AU.split_documents(spark, SF_DIR), **AU.VARIANTS["top1000"]))

    queries = {
        "flagship_forecast_pairs": lambda: forecast.forecast_pairs(ticks, "1 hour", 4),
        "r1_resample_5min": bars5,
        "r1_resample_hourly_to_daily": lambda: B.resample_bars(hourly(), "1 day"),
        "w1_lead_target": lambda: X.lead_target(bars5()),
        "w2_windows_b72": lambda: X.sequence_windows(X.lead_target(bars5()), ["close", "volume"], 72, target="target"),
        "m1_fold_b72": m1_fold,
        "m2_bulk_b72": m2_bulk,
        "m5_train_per_symbol": lambda: TR.train_symbols(hourly()),
        "m6_train_epoch": m6_epoch,
        "d1_split_l2_retention": lambda: B.rolling_retention(B.chronological_split(bars5()), 288),
        "t6_tfidf_top1000": t6,
        "t8_naive_bayes": t8,
        "st5_stream_scoring": st5_stream,
    }
    run(B.ticks_to_bars(ticks, "1 day"))                      # warm-up
    times, cold = {}, {}
    for name, build in queries.items():
        runs = []
        for _ in range(RUNS):
            t0 = time.time()
            run(build())
            runs.append(round(time.time() - t0, 3))
        times[name], cold[name] = min(runs), runs[0]
        print(f"{name}: {runs}", file=sys.stderr)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": CPUS, "runs": RUNS, "cold": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
