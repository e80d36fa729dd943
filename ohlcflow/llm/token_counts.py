"""Operator 5: token counts as delta-maintained rollups.

Every change of a document is an image pair (before, after): an insert has no
before, a delete no after, a revised count (new text, source, language or
tokenizer version) has both. ``signed_deltas`` turns images into additive
rows (-1 / +1 documents, -n / +n tokens), pre-aggregated per key, so a batch
of any size becomes one row per (source, lang, tokenizer_version) and task.
``RollupStore`` keeps each batch's aggregated deltas in a folder of its own
below one root, and in a commit log which folders count. Committing a batch id
again puts its new folder in place of the old one; the log moves last, in one
step, so replays and retries change nothing, and a crash leaves the batch as it
was before. A store opened anew goes on from its log. Totals are sums over the
committed batches; the log names every batch, a line of text each.

Defined cases: null text counts 0 tokens; null source or language is a key of
its own; a change whose before and after are both null adds nothing; empty
input gives an empty rollup; repeated rows count as often as they occur; keys
whose documents sum to 0 stay out of ``totals``; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.store import CommitLog

KEYS = ["source", "lang", "tokenizer_version"]

# Tokenizer versions countable by built-in functions: name -> pattern counted.
VERSIONS = {"space-1": r"\S+", "wordpunct-2": r"[A-Za-z0-9]+|[^A-Za-z0-9\s]"}


def image(source, lang, version, n_tokens) -> Column:
    return F.struct(F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"),
                    F.lit(version).alias("tokenizer_version"),
                    F.coalesce(n_tokens, F.lit(0)).cast("bigint").alias("n_tokens"))


def counted(text: str, version: str) -> Column:
    """Tokens of a text column under a built-in tokenizer version."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(VERSIONS[version])), F.lit(0))


def signed_deltas(changes: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """(before, after) images -> additive rows per key: KEYS, d_docs, d_tokens."""
    signed = F.filter(F.array(F.struct(F.lit(-1).alias("sign"), F.col(before).alias("i")),
                              F.struct(F.lit(1).alias("sign"), F.col(after).alias("i"))),
                      lambda x: x["i"].isNotNull())
    rows = changes.select(F.explode(signed).alias("_s")).select(
        *[F.col(f"_s.i.{k}").alias(k) for k in KEYS], F.col("_s.sign").cast("bigint").alias("d_docs"),
        (F.col("_s.sign") * F.col("_s.i.n_tokens")).alias("d_tokens"))
    return rows.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))


class RollupStore(CommitLog):
    """Committed delta batches below ``root`` (a folder all executors share);
    one writer at a time, a second one fails at its commit."""

    nothing = {"version": 0, "batches": {}}

    def commit(self, batch_id: str, deltas: DataFrame) -> None:
        """Add the batch's deltas, in place of any earlier commit of it."""
        if not batch_id or not all(c.isalnum() or c in "-_" for c in batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits, - and _ only")
        old, folder = self.latest(), f"{batch_id}.{uuid.uuid4().hex}"
        deltas.write.parquet(f"{self.root}/data/{folder}")
        new = self._commit(old, batches={**old["batches"], batch_id: folder})
        for v in self.versions():
            if v < new["version"]:
                self._fs.delete(self._path(f"_log/{v:020d}.json"), False)
        for name in set(self._list("data")) - set(new["batches"].values()):
            self._fs.delete(self._path(f"data/{name}"), True)

    def deltas(self) -> DataFrame:
        schema = ", ".join(f"{k} string" for k in KEYS) + ", d_docs bigint, d_tokens bigint"
        folders = sorted(self.latest()["batches"].values())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f}" for f in folders])

    def totals(self) -> DataFrame:
        """KEYS, n_docs, n_tokens over all committed batches."""
        return (self.deltas().groupBy(*KEYS)
                .agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
                .where(F.col("n_docs") != 0))
