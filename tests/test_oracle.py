"""Registered queries against their DuckDB SQL on the smallest driver tables
(the same comparison the correctness gate runs at sf0.01)."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL, have_testdata

sys.path.insert(0, os.path.join(ROOT, "tools"))

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver tables missing")

SAMPLE = ["forecast_pairs", "forecast_error", "bars_hourly", "bars_daily_from_hourly", "frames_decode",
          "rolling_retention", "chronological_split", "random_split", "sequence_windows", "lag_features",
          "predict_next", "validation_report", "tfidf_weights", "nb_predictions", "forecast_pairs_bulk",
          "stream_forecast_pairs", "stream_resample"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    from oracle_check import TABLES
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    import __spark_entry__ as E
    from oracle_check import digest
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
