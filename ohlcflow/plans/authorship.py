"""Labelled-text plans: hold-out split, TF-IDF, Bernoulli naive Bayes.

``vectorize`` mirrors the two vectoriser settings of the reference:
stop words removed with the full training vocabulary (unigrams), and stop
words removed with uni- plus bigrams limited to the 1000 most frequent terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import tables
from ..operators import text as TX
from ..operators.bars import random_split
from ..session import materialize, stored


def split_documents(spark: SparkSession, sf_dir: str, train_percent: int = 80, seed: int = 1234) -> DataFrame:
    """T1 + D2: (doc_id, label, text, split)."""
    return random_split(tables.documents(spark, sf_dir), "doc_id", train_percent, seed)


@dataclass
class Vectorized:
    docs: DataFrame        # (doc_id, label, text, split)
    tf: DataFrame          # (doc_id, label, split, term, tf), all documents; a bounded vocabulary's terms only
    vocab: DataFrame       # (term, tf_total, df)
    idf: DataFrame         # (term, idf)
    weights: DataFrame     # (doc_id, label, split, term, tf, weight)
    n_train: int
    bounded: bool


def vectorize(docs: DataFrame, stop_words: bool = True, ngram_max: int = 1,
              max_features: int | None = None, store: bool = True) -> Vectorized:
    """Fit the vocabulary and IDF on the train split, apply to all.

    A full vocabulary needs every (document, term) row twice, so with ``store``
    they are written once, compressed, to the shared folder. A bounded one is
    counted first and the texts are tokenised again for its few terms: the rows
    of all other terms, far larger than the texts, are never written. Those left
    keep their ``doc_id`` partitioning, so the per-document L2 norm needs no
    further exchange. The vocabulary is written once.
    """
    bounded = max_features is not None
    tf = TX.term_frequencies(docs, stop_words, ngram_max)
    if store and not bounded:
        tf = stored(tf, "terms")
    vocab = TX.vocabulary(tf.where(F.col("split") == "train"), max_features)
    if store:
        vocab = materialize(vocab)
    if bounded:
        tf = TX.term_frequencies(docs, stop_words, ngram_max, vocab=vocab)
    n_train = docs.where(F.col("split") == "train").count()
    idf = TX.smooth_idf(vocab, n_train)
    return Vectorized(docs, tf, vocab, idf, TX.tfidf(tf, idf, bounded), n_train, bounded)


def naive_bayes(v: Vectorized, alpha: float = 1.0) -> DataFrame:
    """Fit on train presence, predict the test split.

    Presence is "tf-idf weight > 0", which holds exactly for the vocabulary
    terms of a document (tf >= 1, idf >= 1), so it is taken from the term
    table joined with the vocabulary; the normalising window is not needed.
    """
    vocab_terms = v.vocab.select("term")
    present = v.tf.join(F.broadcast(vocab_terms) if v.bounded else vocab_terms, "term", "inner")
    if v.bounded:                                       # read by the fit and by the prediction
        present = stored(present, "present")
    model = TX.BernoulliNB.fit(
        present.where(F.col("split") == "train").select("doc_id", "label", "term"),
        v.docs.where(F.col("split") == "train").select("doc_id", "label"),
        v.vocab, alpha, v.bounded)
    test_docs = v.docs.where(F.col("split") == "test").select("doc_id", "label")
    return model.predict(test_docs, present.where(F.col("split") == "test").select("doc_id", "term"))


VARIANTS = {
    "full": dict(stop_words=True, ngram_max=1, max_features=None),
    "top1000": dict(stop_words=True, ngram_max=2, max_features=1000),
}
