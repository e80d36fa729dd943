"""Text operators against brute force on small document sets."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ohlcflow.functions.text import add_terms, english_stop_words
from ohlcflow.operators import classify as CL
from ohlcflow.operators import text as TX
from ohlcflow.session import scratch_path

DOCS = [
    (1, "a", "The cat sat on the mat. The cat ran!", "train"),
    (2, "a", "Cats and dogs; the dog sat.", "train"),
    (3, "b", "Stocks rose, stocks fell: markets moved 12 points", "train"),
    (4, "b", "Markets fell and stocks sank", "train"),
    (5, "a", "the mat, the cat", "test"),
    (6, "b", "stocks and markets", "test"),
    (7, "b", "x y z", "test"),                      # no token of 2+ characters
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, label string, text string, split string")


def brute_terms(text, stop=True, ngram=1):
    import regex
    toks = regex.findall(r"[\p{L}\p{N}_]{2,}", text.lower())
    if stop:
        sw = set(english_stop_words())
        toks = [t for t in toks if t not in sw]
    out = list(toks)
    if ngram == 2:
        out += [f"{a} {b}" for a, b in zip(toks, toks[1:])]
    return out


def test_stop_words_list():
    sw = english_stop_words()
    assert len(sw) == 181 and "the" in sw and "and" in sw


def test_terms_match_brute_force(docs):
    got = {r.doc_id: r.terms for r in add_terms(docs, "text", "terms", True, 2).collect()}
    for d, _, text, _ in DOCS:
        assert got[d] == brute_terms(text, True, 2)


def brute_tfidf(max_features=None, ngram=2):
    train = [d for d in DOCS if d[3] == "train"]
    tfs = {d[0]: Counter(brute_terms(d[2], True, ngram)) for d in DOCS}
    total, df = Counter(), Counter()
    for d in train:
        total.update(tfs[d[0]])
        df.update(set(tfs[d[0]]))
    vocab = sorted(total, key=lambda t: (-total[t], t))[:max_features] if max_features else list(total)
    n = len(train)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    out = {}
    for d in DOCS:
        w = {t: c * idf[t] for t, c in tfs[d[0]].items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.update({(d[0], t): v / norm for t, v in w.items()})
    return vocab, out


def test_tfidf_matches_brute_force(docs):
    tf = TX.term_frequencies(docs, True, 2)
    vocab = TX.vocabulary(tf.where("split = 'train'"), 5)
    idf = TX.smooth_idf(vocab, 4)
    got = {(r.doc_id, r.term): r.weight for r in TX.tfidf(tf, idf, bounded=True).collect()}
    exp_vocab, exp = brute_tfidf(5)
    assert sorted(r.term for r in vocab.collect()) == sorted(exp_vocab)
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_tokenising_tasks_do_not_grow_with_the_corpus(spark, monkeypatch):
    """Partitions go by the whole text, not by compressed bytes that AQE merges;
    rows that share an id are still counted together."""
    rows = [(i % 50, "a", f"word{i % 7} word{i % 3} tail{i}", "train") for i in range(200)] + [(None, "a", "word0 word1", "train")]
    df = spark.createDataFrame(rows, "doc_id long, label string, text string, split string")
    monkeypatch.setattr(TX, "PART_BYTES", 100)
    size = sum(len(r[2]) for r in rows)
    tf = TX.term_frequencies(df, True, 2)
    got = {(r.doc_id, r.term): r.tf for r in tf.collect()}
    assert tf.rdd.getNumPartitions() == size // 100 + 1 > 30
    want = Counter((r[0], t) for r in rows for t in brute_terms(r[2], True, 2))
    assert got == want


def test_bounded_vocabulary_never_writes_other_terms(spark, docs):
    """Texts are tokenised again for the vocabulary's terms; the weights are the same."""
    from ohlcflow.plans import authorship as AU
    v = AU.vectorize(docs, True, 2, 5)
    vocab, exp = brute_tfidf(5)
    assert {r.term for r in v.tf.select("term").distinct().collect()} == set(vocab)
    got = {(r.doc_id, r.term): r.weight for r in v.weights.collect()}
    assert got.keys() == exp.keys() and all(abs(got[k] - exp[k]) < 1e-12 for k in exp)
    assert AU.naive_bayes(v).count() == 3


def test_bernoulli_nb_matches_brute_force(docs):
    tf = TX.term_frequencies(docs, True, 1)
    vocab = TX.vocabulary(tf.where("split = 'train'"))
    pres = tf.select("doc_id", "label", "split", "term")
    model = TX.BernoulliNB.fit(pres.where("split = 'train'").select("doc_id", "label", "term"),
                               docs.where("split = 'train'").select("doc_id", "label"), vocab)
    pred = {r.doc_id: r.predicted for r in
            model.predict(docs.where("split = 'test'").select("doc_id", "label"),
                          pres.where("split = 'test'").select("doc_id", "term")).collect()}
    # brute force
    train = [d for d in DOCS if d[3] == "train"]
    V = sorted({t for d in train for t in brute_terms(d[2])})
    classes = sorted({d[1] for d in train})
    exp = {}
    for d in DOCS:
        if d[3] != "test":
            continue
        x = set(brute_terms(d[2]))
        best = None
        for c in classes:
            docs_c = [set(brute_terms(e[2])) for e in train if e[1] == c]
            j = math.log(len(docs_c) / len(train))
            for t in V:
                p = (sum(t in s for s in docs_c) + 1) / (len(docs_c) + 2)
                j += math.log(p) if t in x else math.log(1 - p)
            if best is None or j > best[0] + 1e-12:
                best = (j, c)
        exp[d[0]] = best[1]
    assert pred == exp
    assert set(pred) == {5, 6, 7}                    # a document without terms is still scored


def test_metrics(spark):
    p = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "b", "b")],
                              "doc_id long, label string, predicted string")
    assert TX.accuracy(p).first().accuracy == 0.75
    rep = {r.label: r for r in TX.class_report(p).collect()}
    assert rep["a"].precision == 1.0 and rep["a"].recall == 0.5
    assert rep["b"].precision == pytest.approx(2 / 3) and rep["b"].support == 2
    assert {(r.label, r.predicted, r["count"]) for r in TX.confusion(p).collect()} == \
        {("a", "a", 1), ("a", "b", 1), ("b", "b", 2)}


def test_ml_pipeline_smooth_idf_and_save(spark, docs, tmp_path):
    train = docs.where("split = 'train'")
    model = CL.naive_bayes_pipeline(50).fit(train)
    out = CL.predict(model, docs.where("split = 'test'"))
    assert out.count() == 3
    path = str(tmp_path / "nb")
    CL.save_model(model, path)                                             # K6
    back = CL.load_model(path)
    again = CL.predict(back, docs.where("split = 'test'"))
    assert sorted(r.predicted for r in again.collect()) == sorted(r.predicted for r in out.collect())
    # SmoothIdf = ln((1+n)/(1+df)) + 1 times tf, then L2
    from pyspark.ml import Pipeline
    fm = Pipeline(stages=CL.feature_stages(stop_words=True, max_features=1000)).fit(train)
    vocab = fm.stages[2].vocabulary
    v = fm.transform(train.where("doc_id = 1")).first().features.toArray()
    _, exp = brute_tfidf(None, 1)
    for t, w in zip(vocab, v):
        assert w == pytest.approx(exp.get((1, t), 0.0), abs=1e-12)
    assert any(p[1] == "pattern" for p in CL.describe(fm))                  # T11


def test_top_terms_break_ties_by_term(spark):
    """Twenty terms of the same count: the smallest are kept, however rows lie;
    the model has the parameters and counts of a fitted CountVectorizer."""
    from pyspark.ml.feature import CountVectorizer
    rows = [([f"t{i:02d}", "often", "often"],) for i in range(19, -1, -1)] + [([],)]
    df = spark.createDataFrame(rows, "terms array<string>")
    for parts in (1, 7):
        model = CL.TopTerms(inputCol="terms", outputCol="v", vocab_size=6, binary=True).fit(df.repartition(parts))
        assert model.vocabulary == ["often", "t00", "t01", "t02", "t03", "t04"]
    theirs = CountVectorizer(inputCol="terms", outputCol="v", vocabSize=6, minDF=1.0, binary=True).fit(df)
    assert sorted(CL.describe(type("P", (), {"stages": [theirs]}))) == \
        sorted(CL.describe(type("P", (), {"stages": [model]})))
    assert [r.v.toArray().tolist() for r in model.transform(df).collect()][-2:] == [[1, 1, 0, 0, 0, 0], [0] * 6]


def test_logistic_weights(spark, docs):
    w = CL.balanced_weights(docs.where("split = 'train'"))
    got = {r.label: r.weight for r in w.select("label", "weight").distinct().collect()}
    assert got == {"a": 1.0, "b": 1.0}


def test_hashed_learners_separate_labels_and_score_unlabelled(spark):
    """LR, cross-validated LR and MLP learn two word sets; a document without
    a label is scored, an empty or null text too."""
    rows = [(i, lab, f"{lab}word{i % 3} {lab}word{i % 2} common", "train") for i in range(24) for lab in ("x", "y")]
    train = spark.createDataFrame(rows, "doc_id int, label string, text string, split string")
    test = spark.createDataFrame([(1, "x", "xword0 common"), (2, None, "yword1 common"), (3, "new", "xword1 xword2"),
                                  (4, "y", "")], "doc_id int, label string, text string")
    weighted = CL.balanced_weights(train)
    models = [*CL.fit_logistic(weighted).values(), CL.cross_validated_logistic(weighted),
              CL.fit_mlp(train, (5, 3), hashed=64)]
    for m in models:
        got = {r.doc_id: r.predicted for r in CL.predict(m, test).collect()}
        assert (got[1], got[2], got[3]) == ("x", "y", "x") and got[4] in ("x", "y")


def test_fold_fits_see_their_own_rows_only(spark, monkeypatch):
    """Document frequencies, class weights and regParam of every fold's fit
    equal those of a separate fit; the tuned model stores and loads."""
    rng = random.Random(2)
    rows = [(i, lab, " ".join(rng.choice(f"{lab}a {lab}b c d e".split()) for _ in range(8))) for i in range(60)
            for lab in ("x", "y", "x")[:1 + i % 3]]
    train = spark.createDataFrame([(k, lab, t) for k, (_, lab, t) in enumerate(rows)], "doc_id long, label string, text string")
    seen = []
    plain = CL.logistic

    class Spy:
        def __init__(self, C, n, lr):
            self.C, self.n, self.lr = C, n, lr

        def fit(self, df):
            seen.append((self.C, self.n, df.select("label_index", "weight", "features").collect()))
            return self.lr.fit(df)

    def logistic(C, n, max_iter=100):
        calls.append(1)
        lr = plain(C, n, max_iter)
        return lr if len(calls) == 1 else Spy(C, n, lr)                # the first is the grid's

    calls = []
    monkeypatch.setattr(CL, "logistic", logistic)
    model = CL.tune_logistic(train, (1.0, 2.0), 3, hashed=64, max_iter=20)
    folds = train.withColumn("fold", CL.fold_of("doc_id", 3))
    want = []
    for part in [folds.where(F.col("fold") != f) for f in range(3)] + [folds]:
        prep = CL.Pipeline(stages=[CL.label_stage(), *CL.feature_stages(hashed=64)]).fit(part)
        rows_ = prep.transform(CL.balanced_weights(part)).select("label_index", "weight", "features").collect()
        want.append((float(part.count()), rows_))

    def shown(rows_):
        return sorted((r.label_index, round(r.weight, 9), [round(x, 9) for x in r.features.toArray()]) for r in rows_)

    assert len(seen) == 7
    expected = {(n, str(shown(r))) for n, r in want}
    assert {(n, str(shown(r))) for _, n, r in seen} == expected
    path = scratch_path(spark, "tuned")
    CL.save_model(model, path)
    back = CL.load_tuned(path)
    assert back.avgMetrics == model.avgMetrics and len(CL.tuning_report(back)) == 2
    assert sum(r[-1] for r in CL.tuning_report(back)) == 1 and CL.tuning_report(back) == CL.tuning_report(model)
    a, b = (CL.predict(m.bestModel, train).select("doc_id", "predicted").orderBy("doc_id").collect() for m in (model, back))
    assert a == b and sum(r.predicted == lab for r, (_, lab, _t) in zip(a, rows)) > 0.9 * len(rows)


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(CL, "MAX_LABELS", 2)
    df = spark.createDataFrame([(i, str(i), "a") for i in range(3)], "doc_id long, label string, text string")
    for fit in (CL.balanced_weights, CL.tune_logistic):
        with pytest.raises(ValueError, match="labels"):
            fit(df)
