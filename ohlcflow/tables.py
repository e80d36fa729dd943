"""Binding of the driver's tables to the engine's data model.

* ticks  <- ``events``: symbol := event_type, price := value,
  size := props.k, sequence := event_id (tie-break inside one instant).
* daily  <- ``orders``: one price series per order status, price := o_totalprice.
* documents <- ``documents``: label := lang.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades: (symbol, ts, seq, price, size). Only five columns are read."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("symbol"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("size"),
    )


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as daily price ticks: (symbol, ts, seq, price, size=1)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderstatus").alias("symbol"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).cast("bigint").alias("size"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: (doc_id, label, text)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("lang").alias("label"), "text")


# DuckDB text of the same bindings, shared by the oracle queries.
SQL_TICKS = (
    "SELECT event_type AS symbol, ts, event_id AS seq, value AS price, "
    "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS size FROM events"
)
SQL_DAILY_ROWS = (
    "SELECT o_orderstatus AS symbol, o_orderdate AS ts, o_orderkey AS seq, "
    "o_totalprice AS price, CAST(1 AS BIGINT) AS size FROM orders"
)
SQL_DOCUMENTS = "SELECT doc_id, lang AS label, text FROM documents"
