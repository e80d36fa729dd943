"""Text queries (T2-T8, A4-A6) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import add_terms, sql_terms, sql_tokens
from ..operators import text as TX
from . import authorship as AU
from .registry import register, rounded

DOCS_SQL = """SELECT doc_id, lang AS label, text,
  CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '1234'), 1, 8))::BIGINT % 100 AS INTEGER) < 80
       THEN 'train' ELSE 'test' END AS split FROM documents"""


def _tf_sql(stop_words: bool, ngram_max: int, max_features: int | None) -> str:
    limit = f"ORDER BY tf_total DESC, term LIMIT {max_features}" if max_features else ""
    return f"""docs AS ({DOCS_SQL}),
toks AS (SELECT doc_id, label, split, {sql_tokens('text', stop_words)} AS f FROM docs),
occ AS (SELECT doc_id, label, split, unnest({sql_terms('f', ngram_max)}) AS term FROM toks),
tf AS (SELECT doc_id, label, split, term, count(*) AS tf FROM occ GROUP BY ALL),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf_total, count(*) AS df FROM tf WHERE split = 'train'
          GROUP BY term {limit}),
ntr AS (SELECT count(*) AS n FROM docs WHERE split = 'train'),
idf AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM vocab, ntr),
wt AS (SELECT doc_id, label, split, term, tf, tf * idf AS w FROM tf JOIN idf USING (term)),
weights AS (SELECT doc_id, label, split, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM wt)"""


def _nb_sql(stop_words: bool, ngram_max: int, max_features: int | None) -> str:
    return _tf_sql(stop_words, ngram_max, max_features) + """,
cls AS (SELECT label, count(*) AS nc FROM docs WHERE split = 'train' GROUP BY label),
tot AS (SELECT sum(nc) AS n FROM cls),
cnt AS (SELECT term, label, count(*) AS n FROM weights WHERE split = 'train' AND weight > 0 GROUP BY term, label),
prob AS (SELECT v.term, c.label, (coalesce(cnt.n, 0) + 1.0) / (c.nc + 2.0) AS p
         FROM vocab v CROSS JOIN cls c LEFT JOIN cnt ON cnt.term = v.term AND cnt.label = c.label),
base AS (SELECT c.label, ln(c.nc / tot.n) + s.l1 AS base
         FROM cls c CROSS JOIN tot JOIN (SELECT label, sum(ln(1.0 - p)) AS l1 FROM prob GROUP BY label) s USING (label)),
test AS (SELECT doc_id, label FROM docs WHERE split = 'test'),
tpres AS (SELECT doc_id, term FROM weights WHERE split = 'test' AND weight > 0),
dsum AS (SELECT tp.doc_id, pr.label, sum(ln(pr.p) - ln(1.0 - pr.p)) AS s FROM tpres tp JOIN prob pr USING (term) GROUP BY ALL),
jll AS (SELECT t.doc_id, t.label AS truth, b.label AS cls, b.base + coalesce(d.s, 0.0) AS jll
        FROM test t CROSS JOIN base b LEFT JOIN dsum d ON d.doc_id = t.doc_id AND d.label = b.label),
pred AS (SELECT doc_id, truth AS label, cls AS predicted FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY jll DESC, cls) AS rn FROM jll) WHERE rn = 1)"""


TOP = AU.VARIANTS["top1000"]
FULL = AU.VARIANTS["full"]


def _nb(spark, sf_dir, variant):
    docs = AU.split_documents(spark, sf_dir)
    return AU.naive_bayes(AU.vectorize(docs, **variant))


@register("token_counts", f"""SELECT doc_id, CAST(len({sql_tokens('text', False)}) AS INTEGER) AS n_tokens,
  CAST(len(f) AS INTEGER) AS n_filtered, CAST(len({sql_terms('f', 2)}) AS INTEGER) AS n_terms
  FROM (SELECT doc_id, text, {sql_tokens('text', True)} AS f FROM documents)""")
def q_token_counts(spark, sf_dir):
    """T2-T4 over whole texts: tokens, tokens without stop words, uni+bigrams."""
    from .. import tables
    d = tables.documents(spark, sf_dir).select("doc_id", "text")
    d = add_terms(add_terms(add_terms(d, "text", "t0", False, 1), "text", "t1", True, 1), "text", "t2", True, 2)
    return d.select("doc_id", F.size("t0").alias("n_tokens"), F.size("t1").alias("n_filtered"),
                    F.size("t2").alias("n_terms"))


@register("vocabulary_top", "WITH " + _tf_sql(True, 2, 1000) + "\nSELECT term, tf_total, df FROM vocab")
def q_vocab(spark, sf_dir):
    """T5: 1000 most frequent uni/bigrams of the training split."""
    docs = AU.split_documents(spark, sf_dir)
    tf = TX.term_frequencies(docs, True, 2)
    return TX.vocabulary(tf.where(F.col("split") == "train"), 1000)


@register("tfidf_weights", "WITH " + _tf_sql(True, 2, 1000) + "\nSELECT doc_id, term, tf, R6(weight) AS weight FROM weights")
def q_tfidf(spark, sf_dir):
    """Smooth-idf, L2-normalised weights of every document."""
    v = AU.vectorize(AU.split_documents(spark, sf_dir), **TOP)
    return rounded(v.weights.select("doc_id", "term", "tf", "weight"))


@register("tfidf_shape", "WITH " + _tf_sql(True, 1, None).replace("vocab AS", "vocab_full AS").replace(
    "FROM vocab, ntr", "FROM vocab_full, ntr") + """,
docs2 AS (SELECT split FROM docs)
SELECT 'full' AS variant, split, count(*) AS rows, (SELECT count(*) FROM vocab_full) AS vocabulary
FROM docs2 GROUP BY split""")
def q_shape(spark, sf_dir):
    """Rows x vocabulary per split (full vocabulary, unigrams)."""
    v = AU.vectorize(AU.split_documents(spark, sf_dir), **FULL)
    n_vocab = v.vocab.count()
    return (v.docs.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit("full").alias("variant"), "split", "rows", F.lit(n_vocab).cast("bigint").alias("vocabulary")))


@register("nb_predictions", "WITH " + _nb_sql(True, 2, 1000) + "\nSELECT doc_id, label, predicted FROM pred")
def q_nb_predictions(spark, sf_dir):
    """Bernoulli NB on the 1000 uni/bigram vocabulary."""
    return _nb(spark, sf_dir, TOP).select("doc_id", "label", "predicted")


@register("nb_full_predictions", "WITH " + _nb_sql(True, 1, None) + "\nSELECT doc_id, label, predicted FROM pred")
def q_nb_full(spark, sf_dir):
    """T8 on the full training vocabulary (first vectoriser setting)."""
    return _nb(spark, sf_dir, FULL).select("doc_id", "label", "predicted")


@register("nb_accuracy", "WITH " + _nb_sql(True, 2, 1000) +
          "\nSELECT R6(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END)) AS accuracy, count(*) AS rows FROM pred")
def q_nb_accuracy(spark, sf_dir):
    """A5."""
    return rounded(TX.accuracy(_nb(spark, sf_dir, TOP)))


@register("nb_confusion", "WITH " + _nb_sql(True, 2, 1000) +
          "\nSELECT label, predicted, count(*) AS count FROM pred GROUP BY label, predicted")
def q_nb_confusion(spark, sf_dir):
    """Confusion counts."""
    return TX.confusion(_nb(spark, sf_dir, TOP))


@register("nb_class_report", "WITH " + _nb_sql(True, 2, 1000) + """,
truth AS (SELECT label AS cls, count(*) AS support FROM pred GROUP BY label),
guessed AS (SELECT predicted AS cls, count(*) AS guessed FROM pred GROUP BY predicted),
hit AS (SELECT label AS cls, count(*) AS tp FROM pred WHERE label = predicted GROUP BY label),
r AS (SELECT coalesce(t.cls, g.cls) AS cls, coalesce(support, 0) AS support, coalesce(guessed, 0) AS guessed,
             coalesce(tp, 0) AS tp
      FROM truth t FULL JOIN guessed g ON t.cls = g.cls LEFT JOIN hit h ON h.cls = coalesce(t.cls, g.cls)),
m AS (SELECT cls, support, CASE WHEN guessed > 0 THEN tp / guessed ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM r)
SELECT cls AS label, R6(precision) AS precision, R6(recall) AS recall,
       R6(CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END) AS f1,
       support FROM m""")
def q_nb_report(spark, sf_dir):
    """Per-class precision, recall, F1, support."""
    return rounded(TX.class_report(_nb(spark, sf_dir, TOP)))
