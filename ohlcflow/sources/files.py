"""File sources and sinks.

Readers always pass an explicit schema (schema inference reads the data an
extra time and guesses per file); ``infer=True`` is kept for ad-hoc use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import parse_bar_time
from ..schema import BAR_COLUMNS, CSV_BAR, DAILY_CSV, WIRE_BAR
from .codec import BAR_TYPES, CSV_TO_BAR


def _with_symbol_partition(schema):
    """Reader schema plus the ``symbol`` partition column (folders
    ``symbol=...`` written by the partitioned writers)."""
    from pyspark.sql import types as T
    return T.StructType([*schema.fields, T.StructField("symbol", T.StringType())])


def _to_engine(df: DataFrame, symbol) -> DataFrame:
    if symbol is None and "symbol" in df.columns:
        symbol = F.col("symbol")
    sym = F.lit(symbol) if isinstance(symbol, str) or symbol is None else symbol
    out = [sym.cast("string").alias("symbol"), parse_bar_time(F.col("Date").cast("string")).alias("ts")]
    for src, dst in CSV_TO_BAR.items():
        if src == "Date":
            continue
        out.append(F.col(src).cast("string").try_cast(BAR_TYPES[dst]).alias(dst))
    return df.select(*out)


def read_bars_csv(spark: SparkSession, path: str, symbol: str | None = None, infer: bool = False) -> DataFrame:
    """Headered bar CSV (``Date,Open,High,Low,Close,Volume,Trade_count,vwap``).

    Without ``symbol`` the symbol comes from ``symbol=...`` partition folders.
    """
    r = spark.read.option("header", True)
    r = r.option("inferSchema", True) if infer else r.schema(CSV_BAR if symbol else _with_symbol_partition(CSV_BAR))
    return _to_engine(r.csv(path), symbol)


def read_daily_csv(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """Daily prices, ``M/d/yyyy`` dates and grouped volumes ("1,657,300")."""
    schema = DAILY_CSV if symbol else _with_symbol_partition(DAILY_CSV)
    df = spark.read.option("header", True).schema(schema).csv(path)
    sym = (F.lit(symbol) if symbol else F.col("symbol")).cast("string")
    return df.select(sym.alias("symbol"),
                     F.to_date("Date", "M/d/yyyy").alias("date"),
                     F.col("Open").alias("open"), F.col("High").alias("high"),
                     F.col("Low").alias("low"), F.col("Close").alias("close"),
                     F.regexp_replace("Volume", ",", "").try_cast("bigint").alias("volume"))


def read_bars_json(spark: SparkSession, path: str, symbol: str | None = None, array: bool = False) -> DataFrame:
    """S3: bar records as JSON lines, or one JSON array (``array=True``).

    Fields are read as strings and cast (numbers may be quoted).
    """
    schema = WIRE_BAR if symbol else _with_symbol_partition(WIRE_BAR)
    df = spark.read.schema(schema).option("multiLine", array).json(path)
    return _to_engine(df, symbol)


def write_bars_csv(bars: DataFrame, path: str, by_symbol: bool = False) -> None:
    """K1: headered CSV in the stored-bar layout, overwrite; ``by_symbol``
    writes one ``symbol=...`` folder per symbol."""
    names = {v: k for k, v in CSV_TO_BAR.items()}
    out = bars.withColumn("ts", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ssXXX"))
    cols = [F.col(c).alias(names[c]) for c in ["ts", *BAR_TYPES]] + (["symbol"] if by_symbol else [])
    w = out.select(*cols).write.mode("overwrite").option("header", True)
    (w.partitionBy("symbol") if by_symbol else w).csv(path)


def write_bars_json(bars: DataFrame, path: str) -> None:
    """Bars as JSON lines with every field quoted (the replay file format),
    one ``symbol=...`` folder per symbol."""
    names = {v: k for k, v in CSV_TO_BAR.items()}
    out = bars.withColumn("ts", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ssXXX"))
    cols = [F.col(c).cast("string").alias(names[c]) for c in ["ts", *BAR_TYPES]]
    out.select(*cols, "symbol").write.mode("overwrite").partitionBy("symbol").json(path)


def write_daily_csv(bars: DataFrame, path: str) -> None:
    """Daily bars in the daily price layout: ``M/d/yyyy`` dates and grouped
    volumes, one ``symbol=...`` folder per symbol."""
    out = bars.select(F.date_format("ts", "M/d/yyyy").alias("Date"), F.col("open").alias("Open"),
                      F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                      F.format_number(F.col("volume"), 0).alias("Volume"), "symbol")
    out.write.mode("overwrite").option("header", True).partitionBy("symbol").csv(path)


def write_bars_parquet(bars: DataFrame, path: str, mode: str = "append") -> None:
    """Rolling dataset storage: Parquet partitioned by symbol and day, so
    symbol and time filters prune files."""
    (bars.withColumn("day", F.to_date("ts"))
     .select(*BAR_COLUMNS, "day")
     .write.mode(mode).partitionBy("symbol", "day").parquet(path))


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K7: prediction report (symbol, ts, current, target, predicted)."""
    w = report.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def write_labelled_csv(docs: DataFrame, path: str) -> None:
    """Headered CSV of labelled documents as ``read_labelled_csv`` takes it:
    quotes doubled, line breaks and outer white space of texts kept; an empty
    text is ``""``, a null one nothing."""
    (docs.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_labelled_csv(spark: SparkSession, path: str, label_col: str = "author", text_col: str = "text",
                      id_col: str | None = None) -> DataFrame:
    """Labelled documents from a headered CSV whose texts span lines.

    Output (doc_id, label, text); without an id column a stable id is derived
    from the text (md5), never from row order.
    """
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    doc_id = (F.col(id_col).cast("bigint") if id_col else
              F.conv(F.substring(F.md5(F.col(text_col)), 1, 15), 16, 10).cast("bigint"))
    return df.select(doc_id.alias("doc_id"), F.col(label_col).alias("label"), F.col(text_col).alias("text"))
