"""Operator 1: benchmark decontamination by spaced-seed hashing.

A seed is a mask over consecutive words that ignores the masked positions, so a
seed still hits where an ignored word was replaced. The masks are all ways in
which the first ``WEIGHT`` matches of an accepted segment can follow each other
(every prefix of a best segment has a positive score), so each overlap begins
with a hit of one of them. Items that need fewer matches use masks of as many
places as they need.

1. Benchmark seeds (hash, item, position) are a table; a bitmap of fixed size
   (``FILTER_BITS``) over their hashes, or-ed together from the tasks, goes to
   all tasks.
2. Documents are scanned once. Positions whose seed passes the bitmap are kept
   with the word hashes ``RADIUS`` around them; near positions share a region.
3. Seed hashes are joined between both sides (a shuffle join: neither side is
   assumed small), giving (region, item, diagonal) candidates.
4. Each candidate is verified by comparing words along the diagonal: the best
   local segment, a match counting 1 and a substitution -PENALTY, is an
   overlap if it has at least ``MIN_WORDS`` matches, or ``SHARE`` of the
   item's words (for short items).

Defined cases: null or empty text, and text without words, is clean; null,
empty or wordless items match nothing; rows of one doc_id are judged
together; null doc_ids are judged as one document with a null id; repeated
items and rows change nothing; with an empty benchmark all are clean.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_CODE, mix64, stored, text_chunks, word_hashes

WEIGHT = 7             # words that a mask compares
MIN_WORDS = 12
SHARE = 0.7
PENALTY = 2.0
RADIUS = 64
FILTER_BITS = 25       # log2 of the bits of the bitmap: 4 MB

SEEDS = "mask int, hash long, item_id long, at int"
REGIONS = "region string, doc_id string, words array<long>, masks array<int>, hashes array<long>, places array<int>"


def needed(n: int) -> int:
    """Matched words that make an overlap with an item of ``n`` words."""
    return min(MIN_WORDS, max(1, int(np.ceil(SHARE * n))))


@lru_cache(maxsize=None)
def masks_of(weight: int) -> tuple[str, ...]:
    """All masks of ``weight`` places whose prefixes score above 0: 1 compares
    a word, 0 ignores it."""
    out = ["1"]
    for done in range(1, weight):
        out = [m + "0" * k + "1" for m in out
               for k in range(len(m)) if done > PENALTY * (m.count("0") + k)]
    return tuple(out)


SPAN = max(len(m) for m in masks_of(WEIGHT))


def mask_places(weights=(WEIGHT,)) -> dict[int, tuple[int, list[int]]]:
    """mask number -> (span, compared places) of all masks of some weights."""
    return {int(m, 2): (len(m), [j for j, c in enumerate(m) if c == "1"]) for w in weights for m in masks_of(w)}


def seed_hashes(words: np.ndarray, mask: int, places: list[int], span: int) -> np.ndarray:
    """Hash of the compared words at every position a mask fits."""
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, (mask * 2654435761) & 0xFFFFFFFF, np.uint64)
    for k, j in enumerate(places):
        h += words[j:j + n] * STEP_CODE[k % len(STEP_CODE)]
    return mix64(h)


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << FILTER_BITS) - 1)
    return (h & low).astype(np.int64), ((h >> np.uint64(32)) & low).astype(np.int64)


def _bit(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def item_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, words (hashes) of items that have words."""
    def run(batches):
        for b in batches:
            h, bounds = word_hashes(list(b["_text"]))
            rows = [(i, h[a:z].view(np.int64).tolist())
                    for i, a, z in zip(b["_id"], bounds, bounds[1:]) if z > a]
            yield pd.DataFrame(rows, columns=["item_id", "words"])

    return (benchmark.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
            .where(F.col("_id").isNotNull()).mapInPandas(run, "item_id long, words array<long>").distinct())


def item_seeds(items: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            out = []
            for item, words in zip(b["item_id"], b["words"]):
                w = np.asarray(words, np.int64).view(np.uint64)
                masks = mask_places([min(WEIGHT, needed(len(w)))])
                for m, (span, places) in masks.items():
                    out += [(m, x, item, j) for j, x in enumerate(seed_hashes(w, m, places, span).view(np.int64).tolist())]
            yield pd.DataFrame(out, columns=["mask", "hash", "item_id", "at"])

    return items.mapInPandas(run, SEEDS)


def bitmap_of(seeds: DataFrame) -> np.ndarray:
    """Packed bits of all seed hashes, or-ed from one bitmap per task (fixed size)."""
    def run(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            for p in _probes(b["hash"].to_numpy(np.int64).view(np.uint64)):
                bits[p] = True
        yield pd.DataFrame({"bits": [np.packbits(bits).tobytes()]})

    all_bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for r in seeds.select("hash").coalesce(8).mapInPandas(run, "bits binary").toLocalIterator():
        all_bits |= np.frombuffer(r.bits, np.uint8)
    return all_bits


def doc_regions(docs: DataFrame, bitmap, masks: dict, id_col: str, text_col: str) -> DataFrame:
    """Stretches of a document around seeds that pass the bitmap."""
    def run(batches):
        import uuid
        bits = np.frombuffer(bitmap.value, np.uint8)
        tag, serial = uuid.uuid4().hex, 0
        for b in batches:
            ids, texts = list(b["_id"]), list(b["_text"])
            out = []
            for a, z in text_chunks(texts, 1 << 20):
                words, bounds = word_hashes(texts[a:z])
                found = []
                for m, (span, places) in masks.items():
                    h = seed_hashes(words, m, places, span)
                    first, second = _probes(h)
                    p = np.flatnonzero(_bit(bits, first))
                    p = p[_bit(bits, second[p])]
                    if not len(p):
                        continue
                    doc = np.searchsorted(bounds, p, side="right") - 1
                    ok = p + span <= bounds[doc + 1]
                    found.append((p[ok], np.full(int(ok.sum()), m), h[p[ok]], doc[ok]))
                if not found:
                    continue
                p, m, h, doc = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(p, kind="stable")
                p, m, h, doc = p[order], m[order], h[order], doc[order]
                split = np.flatnonzero((np.diff(p) > RADIUS) | (np.diff(doc) > 0)) + 1
                for part in np.split(np.arange(len(p)), split):
                    if not len(part):
                        continue
                    d = doc[part[0]]
                    lo = max(bounds[d], p[part[0]] - RADIUS)
                    hi = min(bounds[d + 1], p[part[-1]] + SPAN + RADIUS)
                    serial += 1
                    out.append((f"{tag}-{serial}", ids[a + d],
                                words[lo:hi].view(np.int64).tolist(), m[part].tolist(),
                                h[part].view(np.int64).tolist(), (p[part] - lo).tolist()))
            yield pd.DataFrame(out, columns=["region", "doc_id", "words", "masks", "hashes", "places"])

    return (docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
            .mapInPandas(run, REGIONS).withColumn("doc_id", F.col("doc_id").cast("bigint")))


def best_segment(same: np.ndarray) -> tuple[int, int, int]:
    """(matches, from, to) of the segment with the best match score."""
    best = (0.0, 0, 0)
    run, start = 0.0, 0
    for i, m in enumerate(same.tolist()):
        if run <= 0:
            run, start = 0.0, i
        run += 1.0 if m else -PENALTY
        if run > best[0]:
            best = (run, start, i + 1)
    return int(same[best[1]:best[2]].sum()), best[1], best[2]


def overlap(words: np.ndarray, item: np.ndarray, shift: int) -> int:
    """Matched words of the best segment of ``item`` laid on ``words`` at
    ``shift``; 0 if it is no overlap."""
    lo, hi = max(0, -shift), min(len(item), len(words) - shift)
    if hi <= lo:
        return 0
    n, _, _ = best_segment(words[shift + lo:shift + hi] == item[lo:hi])
    return n if n >= needed(len(item)) else 0


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, matched (most words matched) of every overlap."""
    items = stored(item_words(benchmark, item_col, item_text), "items")
    seeds = item_seeds(items)
    lengths = items.select(F.least(F.size("words"), F.lit(2 * MIN_WORDS)).alias("n")).distinct().collect()
    weights = sorted({min(WEIGHT, needed(r.n)) for r in lengths})
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(bitmap_of(seeds).tobytes())
    regions = stored(doc_regions(docs, bitmap, mask_places(weights), id_col, text_col), "regions")
    seen = (regions.select("region", F.explode(F.arrays_zip("masks", "hashes", "places")).alias("s"))
            .select("region", F.col("s.masks").alias("mask"), F.col("s.hashes").alias("hash"),
                    F.col("s.places").alias("place")))
    near = (seen.join(seeds, ["mask", "hash"])
            .select("region", "item_id", (F.col("place") - F.col("at")).alias("shift")).distinct())

    @F.pandas_udf("int")
    def verified(words: pd.Series, item: pd.Series, shift: pd.Series) -> pd.Series:
        return pd.Series([overlap(np.asarray(w), np.asarray(i), int(s)) for w, i, s in zip(words, item, shift)], dtype="int32")

    rows = (near.join(regions.select("region", "doc_id", "words"), "region")
            .join(items.withColumnRenamed("words", "item"), "item_id")
            .withColumn("matched", verified("words", "item", "shift")).where(F.col("matched") > 0))
    return rows.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **columns) -> DataFrame:
    """One row per doc_id: contaminated, items (ids in order), matched."""
    found = (overlaps(docs, benchmark, id_col, text_col, **columns).groupBy("doc_id")
             .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("matched").alias("matched")))
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id")).distinct()
    hit = found.select(F.col("doc_id").alias("_d"), "items", "matched")
    return (ids.join(hit, F.col("doc_id").eqNullSafe(F.col("_d")), "left")
            .select("doc_id", F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
                    F.coalesce("matched", F.lit(0)).alias("matched")))
