"""Text classification in long form.

Documents become (doc_id, term, tf) rows; the vocabulary, document
frequencies, TF-IDF weights and the Bernoulli naive Bayes model are
aggregations and joins over those rows, so every step is a partial
aggregate or an equi-join that Spark spreads over the cluster.

* Term statistics are partial aggregates: a hot term ("the") is combined on
  the map side before the shuffle.
* Documents are tokenised in partitions of some ``PART_BYTES`` of text, however
  large the corpus: a task's (document, term) rows are some 30 times as large.
* Joins with a vocabulary of at most ``max_features`` terms broadcast it
  (size bound = max_features rows); a full vocabulary grows with the corpus
  and is left to AQE (broadcast below its threshold, shuffle join with
  skew splitting above).
* The L2 norm is a window per document; a document's rows are bounded by its
  distinct terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import add_terms

# Text that one task tokenises and counts.
PART_BYTES = 8 << 20


def by_document(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` hash-partitioned by ``key``, as many partitions as the whole text
    asks for. The number is given, so AQE does not merge partitions by their
    compressed texts, which say little about the rows that come of them."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(int(size // PART_BYTES) + 1, docs.sparkSession.sparkContext.defaultParallelism)
    return docs.repartition(n, key)


def term_occurrences(docs: DataFrame, stop_words: bool = True, ngram_max: int = 1,
                     keep=("label", "split"), colocate: bool = True) -> DataFrame:
    """One row per term occurrence (doc_id, *keep, term).

    With ``colocate`` the documents are hash-partitioned by ``doc_id`` first:
    shuffling the texts once is cheaper than shuffling the (doc, term) rows,
    and every later per-document step (term counts, L2 norm) then runs
    without another exchange.
    """
    keep = [k for k in keep if k in docs.columns]
    d = docs.select("doc_id", *keep, "text")
    if colocate:
        d = by_document(d, "doc_id")
    t = add_terms(d, "text", "terms", stop_words, ngram_max)
    # explode_outer: a plain explode makes the optimizer add a size(terms) > 0
    # filter below the exchange, which would tokenise every text twice.
    occ = t.select("doc_id", *keep, F.explode_outer("terms").alias("term"))
    return occ.where(F.col("term").isNotNull())


def term_frequencies(docs: DataFrame, stop_words: bool = True, ngram_max: int = 1,
                     keep=("label", "split"), colocate: bool = True, vocab: DataFrame | None = None) -> DataFrame:
    """(doc_id, *keep, term, tf); with ``vocab``, a bounded vocabulary, of its
    terms only, dropped before they are counted."""
    keep = [k for k in keep if k in docs.columns]
    occ = term_occurrences(docs, stop_words, ngram_max, keep, colocate)
    if vocab is not None:
        occ = _vocab_join(occ, vocab.select("term"), True)
    return occ.groupBy("doc_id", *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(train_tf: DataFrame, max_features: int | None = None) -> DataFrame:
    """T5: (term, tf_total, df) of the training documents; with
    ``max_features`` only the most frequent terms (ties by term)."""
    v = train_tf.groupBy("term").agg(F.sum("tf").alias("tf_total"), F.count(F.lit(1)).alias("df"))
    if max_features:
        v = v.orderBy(F.desc("tf_total"), "term").limit(int(max_features))
    return v


def smooth_idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    """T6 fit: idf = ln((1 + n) / (1 + df)) + 1 per vocabulary term."""
    n = F.lit(float(n_docs))
    return vocab.select("term", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))


def _vocab_join(rows: DataFrame, table: DataFrame, bounded: bool) -> DataFrame:
    return rows.join(F.broadcast(table) if bounded else table, "term", "inner")


def tfidf(tf: DataFrame, idf: DataFrame, bounded: bool = False) -> DataFrame:
    """T6 apply: (doc_id, ..., term, tf, weight) with L2-normalised weights.

    Terms outside the vocabulary are dropped (as a fitted vectoriser does).
    """
    w = _vocab_join(tf, idf, bounded).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.withColumn("weight", F.col("w") / norm).drop("w", "idf")


def shape(docs: DataFrame, weights: DataFrame, vocab_size: int, split: str | None = None) -> DataFrame:
    """Rows x vocabulary of a vectorised split."""
    d = docs if split is None else docs.where(F.col("split") == split)
    return d.agg(F.count(F.lit(1)).alias("rows")).withColumn("vocabulary", F.lit(int(vocab_size)))


@dataclass
class BernoulliNB:
    """T8 model: classes in sorted order, per-class base log likelihood
    (log prior + sum over the vocabulary of log(1 - p)), and per-term
    deltas log p - log(1 - p) as one array per term."""
    classes: list
    base: list
    deltas: DataFrame          # (term, d array<double>) aligned with classes
    bounded: bool = False

    @staticmethod
    def fit(train_presence: DataFrame, train_docs: DataFrame, vocab: DataFrame,
            alpha: float = 1.0, bounded: bool = False) -> "BernoulliNB":
        """``train_presence``: distinct (doc_id, label, term) of training
        documents; ``train_docs``: (doc_id, label) of every training document
        (including documents without vocabulary terms). Documents without a
        label teach nothing."""
        train_docs, train_presence = (d.where(F.col("label").isNotNull()) for d in (train_docs, train_presence))
        class_counts = {r["label"]: int(r["n"]) for r in
                        train_docs.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        classes = sorted(class_counts)                       # a bounded category set
        total = float(sum(class_counts.values()))
        inv = _vocab_join(train_presence, vocab.select("term"), bounded)
        counts = inv.groupBy("term").pivot("label", classes).agg(F.count(F.lit(1)))
        counts = vocab.select("term").join(counts, "term", "left")
        a = F.lit(float(alpha))
        logp, log1mp = [], []
        for c in classes:
            p = (F.coalesce(F.col(f"`{c}`"), F.lit(0)) + a) / F.lit(class_counts[c] + 2.0 * alpha)
            logp.append(F.log(p))
            log1mp.append(F.log(F.lit(1.0) - p))
        table = counts.select("term", F.array(*[lp - l1 for lp, l1 in zip(logp, log1mp)]).alias("d"),
                              F.array(*log1mp).alias("l1"))
        sums = table.agg(*[F.sum(F.col("l1")[k]).alias(f"s{k}") for k in range(len(classes))]).first()
        import math
        base = [math.log(class_counts[c] / total) + float(sums[f"s{k}"] or 0.0) for k, c in enumerate(classes)]
        return BernoulliNB(classes, base, table.select("term", "d"), bounded)

    def predict(self, docs: DataFrame, presence: DataFrame) -> DataFrame:
        """(doc_id, label, predicted, jll array) for every row of ``docs``;
        ``presence`` holds distinct (doc_id, term) of those documents."""
        k = len(self.classes)
        hits = _vocab_join(presence.select("doc_id", "term"), self.deltas, self.bounded)
        sums = hits.groupBy("doc_id").agg(*[F.sum(F.col("d")[j]).alias(f"s{j}") for j in range(k)])
        out = docs.join(sums, "doc_id", "left")
        jll = F.array(*[F.lit(self.base[j]) + F.coalesce(F.col(f"s{j}"), F.lit(0.0)) for j in range(k)])
        out = out.withColumn("jll", jll)
        classes = F.array(*[F.lit(c) for c in self.classes])
        pos = F.array_position(F.col("jll"), F.array_max("jll"))
        return out.select("doc_id", "label", F.element_at(classes, pos.cast("int")).alias("predicted"), "jll")


def accuracy(pred: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """A5."""
    return pred.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).alias("rows"))


def confusion(pred: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Confusion counts."""
    return pred.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("count"))


def class_report(pred: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Per-class precision, recall, F1 and support."""
    truth = pred.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    guessed = pred.groupBy(F.col(predicted).alias("cls")).agg(F.count(F.lit(1)).alias("guessed"))
    hit = (pred.where(F.col(label) == F.col(predicted)).groupBy(F.col(label).alias("cls"))
           .agg(F.count(F.lit(1)).alias("tp")))
    r = truth.join(guessed, "cls", "full").join(hit, "cls", "left").na.fill(0, ["support", "guessed", "tp"])
    prec = F.when(F.col("guessed") > 0, F.col("tp") / F.col("guessed")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return r.select(F.col("cls").alias("label"), prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), "support")
