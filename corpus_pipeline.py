"""A training corpus from raw documents: ``STAGES`` in order.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``docs``. Rows with a null text
or without letters go in the first stage. ``run`` applies the stages to the
``documents`` table, writing every result to the shared folder in between."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ohlcflow.llm import decontaminate, language_id, near_dedup, packing, pii, queries
from ohlcflow.llm.common import read_table, stored
from ohlcflow.session import ship_package

MIN_SCORE = 0.4       # of the language; a coin toss among the learnt ones is less


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the labelled documents; drop documents whose
    language is unknown (no letters) or uncertain. Where no document is
    labelled there is no language to reject, and only those without go."""
    ship_package(spark)
    model = language_id.fit(docs, ~queries.held_out())
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    got = language_id.predictor(model)("text")
    return docs.where((got["lang_pred"] != language_id.UND) & (got["score"] >= MIN_SCORE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every class of near texts, that with the least doc_id.
    Classes are of texts, not of ids: different texts under one doc_id stay."""
    ship_package(spark)
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark. Overlaps are found
    by text, so rows that share a doc_id, or have none, are judged one by one."""
    ship_package(spark)
    key = f"_{uuid.uuid4().hex}"
    keyed = docs.withColumn(key, F.xxhash64("text"))
    hit = decontaminate.overlaps(keyed.select(key, "text"), read_table(spark, sf_dir, "benchmark"), id_col=key)
    hit = hit.select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by the names of its kinds."""
    ship_package(spark)
    out = docs.withColumn("text", pii.redactor(queries.pii_model())("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of what is left: every piece with its ids and its place
    in a sequence; ``packing.sequences`` joins them to whole sequences."""
    ship_package(spark)
    return packing.pack(docs, queries.tokenizer_path(), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("pack", pack_sequences),
]

# A trained network and hashed signatures are beyond SQL; tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
