"""The corpus pipeline against a brute-force version of its stages."""

import os
import random
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline  # noqa: E402
from ohlcflow.llm import language_id, packing, pii, queries  # noqa: E402
from ohlcflow.llm.common import read_table  # noqa: E402
from test_llm_text import brute_classes, brute_overlaps, check_packing  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_brute_force(spark):
    rng = random.Random(12)
    docs = read_table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.orderBy("doc_id").limit(80).collect()]
    items = {r.item_id: r.text for r in read_table(spark, SF, "benchmark").collect()}
    base = max(rows, key=lambda r: len(r[1]))[1].split()
    near = list(base)
    near[len(near) // 2] = "other"
    n = max(r[0] for r in rows) + 1
    rows += [(n, " ".join(near), "en", None, 1), (n + 1, None, "en", "s", None), (n + 2, "", None, None, 0),
             (n + 3, "1234 !!!", "de", "s", 8), (n + 4, rows[2][1], None, None, 5), rows[5], rows[5],
             (n + 5, " ".join(rng.sample(base, 20)) + " " + items[min(items)] + " call (212) 555-0187 now", "en", "s", 3),
             (n + 6, "mail me at a.b@example.org please my dear friend of old", "en", "s", 9)]
    table = spark.createDataFrame(rows, docs.schema).repartition(3)

    out, got = table, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, out, SF), name)
        got[name] = out
        if name != "pack":
            assert out.columns == docs.columns

    model = language_id.fit(table, ~queries.held_out())
    lang, score = language_id.predict_texts(model, [r[1] for r in rows])
    kept = [r for r, l, s in zip(rows, lang, score) if l != "und" and s >= corpus_pipeline.MIN_SCORE]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got["language_id"].collect()), key=key) == sorted(kept, key=key)

    order = sorted(set(kept), key=lambda r: r[0])
    cls = brute_classes([r[1] for r in order])
    order = [r for i, r in enumerate(order) if cls[i] == i]
    assert sorted(map(tuple, got["near_dedup"].collect()), key=key) == order

    hit = brute_overlaps([r[1] for r in order], items)
    order = [r for i, r in enumerate(order) if not hit.get(i)]
    assert sorted(map(tuple, got["decontaminate"].collect()), key=key) == order
    assert n + 5 not in {r[0] for r in order}

    spans = pii.all_spans(queries.pii_model(), [r[1] for r in order])
    clean = [pii.redact(r[1], s) for r, (_, s) in zip(order, spans)]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got["pii"].collect()) == [
        (r[0], t, len(t)) for r, t in zip(order, clean)]
    assert any("[EMAIL]" in t for t in clean)

    check_packing(got["pack"].collect(), [(r[0], t) for r, t in zip(order, clean)], packing.CAPACITY)


def test_pipeline_bears_an_empty_table(spark):
    out = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
    assert out.count() == 0


def test_clean_documents_stay(spark):
    docs = read_table(spark, SF, "documents")
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    letters = docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert kept.count() >= np.floor(0.99 * letters)
