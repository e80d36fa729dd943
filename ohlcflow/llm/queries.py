"""Registered queries: each applies its operator to its whole table.

``QUERIES`` maps names to (spark, sf_dir) builders, ``ORACLES`` names to
DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from . import (chat, decontaminate, fim, html_text, language_id, near_dedup, packing, pii, simhash, suffix_dedup,
               token_counts, topk, whitening)
from .common import read_table, scratch_path


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def held_out(id_col: str = "doc_id"):
    """The fold that is never learnt from: crc32 of the id as text, mod 5 = 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@lru_cache(maxsize=1)
def pii_model() -> dict:
    return pii.train()


def op1_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, ~held_out())
    return (docs.select("doc_id", held_out().alias("held_out"), language_id.predictor(model)("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


# Fixed value: the extra conversation, whose texts hold control strings.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op3_chat_format(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, chat.USER).otherwise(chat.ASSISTANT).alias("role"),
                                  F.lit(EXTRA_TEXT).alias("text"))
    path = tokenizer_path()
    return chat.digests(chat.format_chat(turns.unionByName(extra), path), path)


def op4_topk_search(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_token_counts(spark, sf_dir):
    """Three batches over all documents: inserts under space-1, revised counts
    that move every non-English document to wordpunct-2, and deletes of texts
    without a token; the first batch is committed twice."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    none = F.lit(None)
    first = token_counts.image("source", "lang", "space-1", token_counts.counted("text", "space-1"))
    second = token_counts.image("source", "lang", "wordpunct-2", token_counts.counted("text", "wordpunct-2"))
    moved = F.coalesce(F.col("lang") != "en", F.lit(False))
    empty = token_counts.counted("text", "space-1") == 0
    typed = none.cast("struct<source:string,lang:string,tokenizer_version:string,n_tokens:bigint>")
    store = token_counts.RollupStore(spark, scratch_path(spark, "rollup"))
    insert = token_counts.signed_deltas(docs.select(typed.alias("before"), first.alias("after")))
    store.commit("insert", insert)
    store.commit("revise", token_counts.signed_deltas(
        docs.where(moved).select(first.alias("before"), second.alias("after"))))
    store.commit("delete", token_counts.signed_deltas(
        docs.where(empty).select(F.when(moved, second).otherwise(first).alias("before"), typed.alias("after"))))
    store.commit("insert", insert)
    return store.totals()


def op6_pii(spark, sf_dir):
    found = pii.personal_data(read_table(spark, sf_dir, "documents"), pii_model())

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_pack(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op9_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op10_html_text(spark, sf_dir):
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


def op11_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark, sf_dir):
    store = fim.frame_store(read_table(spark, sf_dir, "documents"))
    return fim.digests(fim.fill_in_middle(store))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_language_id, op3_chat_format, op4_topk_search,
                                   op5_token_counts, op6_pii, op7_near_dedup, op8_pack, op9_suffix_dedup,
                                   op10_html_text, op11_whitening, op12_simhash, op13_fill_in_middle)}

ORACLES = {
    "op4_topk_search": """WITH f AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT vec_id, min(v) AS v FROM f GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
  CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM d q JOIN d c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_token_counts": r"""WITH c AS (SELECT source, lang, coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) AS n1,
  coalesce(len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\x0B\f\r]')), 0) AS n2 FROM documents),
t AS (SELECT source, lang, CASE WHEN lang <> 'en' THEN 'wordpunct-2' ELSE 'space-1' END AS tokenizer_version,
  CASE WHEN lang <> 'en' THEN n2 ELSE n1 END AS n FROM c WHERE n1 > 0)
SELECT source, lang, tokenizer_version, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM t GROUP BY ALL""",
    "op13_fill_in_middle": r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
  CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b, CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3,
  CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM t),
f AS (SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
  WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
  coalesce(array_to_string(u[1:least(a, b)], ''), '') AS p, coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
  coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM f""",
}
