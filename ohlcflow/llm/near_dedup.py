"""Operator 7: near-duplicate classes by DartMinHash.

A text is a weighted set: its five-word shingles with their numbers of
occurrences. Darts are thrown at the region of every element: cell c of an
element covers weights c to c + 1, and the darts of a cell arrive along the
rank axis as a Poisson process that only hashes of (element, cell) drive, so
equal cells get equal darts in every text. A text keeps the darts below a rank
that makes about K ln K + 4 K of them (more if a coordinate got none), and of
each of the K coordinates the earliest: two texts agree in a coordinate with
the probability of their weighted Jaccard similarity. Cost follows the number
of elements plus darts, not their product.

Equal texts are one node from the start, so copies, however many, take no part
in the search; they get their class at the end, by their text's hash.
Signatures are cut into bands; texts that share a band's hash are candidates.
A bucket gives no pairs among its members: each is compared with the bucket's
most central one, whose own buckets have the most members in sum (the text that
others were made from, where there is one), and a second round compares members
of buckets that still span several classes with another, hashed pick. Members of
buckets that span several classes after that are joined exactly (``rest_pairs``):
texts of different classes that reach the threshold share one of their rarest
cells, at places that leave enough cells behind them. Every link is verified
on the full shingle sets (similarity >= ``THRESHOLD``); the texts of all
candidates are fetched once. Classes grow: a round contracts only its new
links, between the classes known before it.

Defined cases: null and empty texts are classes of their own; a text of one to
four words is one shingle; a text without words is compared as a whole. In
``near_duplicates`` rows of one doc_id are one document (whose texts join their
classes) and rows without a doc_id are not listed. ``one_of_each`` works by
row: different texts under one doc_id stay unless they are near each other, and
rows without a doc_id take part, after all others. An empty table gives no
rows; other columns are ignored, or kept as they are, whatever their types.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_CODE, mix64, stored, text_chunks, word_hashes
from .components import components, least_members

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
K = BANDS * ROWS
DARTS = K * (np.log(K) + 4)
ROUNDS = 2
COUNT_BITS = 18        # log2 of the counters that order cells by rarity: 1 MB

_CELL = np.uint64(0x9E3779B97F4A7C15)
_DART = np.uint64(0xD1B54A32D192ED03)
SIGNATURE = "doc_id string, key binary, bands array<long>"


def cells_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(cell hashes, bounds per text): one cell per occurrence of a shingle,
    the n-th occurrence of a shingle being its n-th cell."""
    words, bounds = word_hashes(texts)
    n = np.diff(bounds)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    raw = {i: t for i, t in enumerate(texts) if t and n[i] == 0}
    count[list(raw)] = 1
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(texts)), count)
    at = bounds[:-1][owner] + np.arange(len(owner)) - out_bounds[:-1][owner]
    pad = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    h = np.zeros(len(owner), np.uint64)
    end = bounds[1:][owner]
    for j in range(SHINGLE):
        h += np.where(at + j < end, pad[np.minimum(at + j, len(pad) - 1)] * STEP_CODE[j], np.uint64(0))
    for i, t in raw.items():
        h[out_bounds[i]] = np.frombuffer(hashlib.md5(t.encode()).digest()[:8], np.uint64)[0]
    h = mix64(h)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    nth = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return mix64(h + nth.astype(np.uint64) * _CELL), out_bounds


def signatures(cells: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The earliest dart of every coordinate: a (texts x K) matrix; rows of
    texts without cells are 0."""
    n = np.diff(bounds)
    sig = np.zeros((len(n), K), np.uint64)
    todo, darts = np.flatnonzero(n), DARTS
    while len(todo):
        local = np.repeat(np.arange(len(todo)), n[todo])
        first = np.cumsum(n[todo]) - n[todo]
        cell = cells[np.arange(len(local)) - first[local] + bounds[todo][local]]
        limit = (darts / n[todo])[local]
        best = np.full(len(todo) * K, np.inf)
        out = np.zeros(len(todo) * K, np.uint64)
        rank, i = np.zeros(len(cell)), 0
        while len(cell):
            i += 1
            u = mix64(cell + np.uint64(i * int(_DART) & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53)
            on = np.flatnonzero(rank < limit)
            cell, local, limit, rank, u = cell[on], local[on], limit[on], rank[on], u[on]
            dart = mix64(u ^ _CELL)
            slot = local * K + (dart % np.uint64(K)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            won = best[slot] == rank
            out[slot[won]] = dart[won]
        full = np.isfinite(best).reshape(-1, K).all(1)
        sig[todo[full]] = out.reshape(-1, K)[full]
        todo, darts = todo[~full], darts * 2
    return sig


def band_hashes(sig: np.ndarray) -> np.ndarray:
    h = np.zeros((len(sig), BANDS), np.uint64)
    for j in range(ROWS):
        h += sig[:, j::ROWS] * STEP_CODE[j]
    return mix64(h + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (hash of the text), bands of rows whose text has content."""
    def run(batches):
        for b in batches:
            ids, texts = list(b["_id"]), list(b["_text"])
            for a, z in text_chunks(texts):
                bands = band_hashes(signatures(*cells_of(texts[a:z])))
                yield pd.DataFrame({"doc_id": ids[a:z], "bands": list(bands),
                                    "key": [hashlib.md5(t.encode()).digest() for t in texts[a:z]]},
                                   columns=["doc_id", "key", "bands"])

    # Ids travel as strings, so that a null among them makes no floats.
    rows = docs.select(F.col(id_col).cast("bigint").cast("string").alias("_id"), F.col(text_col).alias("_text"))
    return (rows.where(F.length("_text") > 0).mapInPandas(run, SIGNATURE)
            .withColumn("doc_id", F.col("doc_id").cast("bigint")))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts, given their distinct cells."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) pairs of ``texts`` (doc_id, text) that reach the threshold."""
    left = pairs.join(texts, pairs.a == texts.doc_id).select("a", "b", F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    @F.pandas_udf("double")
    def sim(text_a: pd.Series, text_b: pd.Series) -> pd.Series:
        out, last, cells_b = [], None, None
        for x, y in zip(text_a, text_b):
            if y != last:
                last, cells_b = y, cells_of([y])[0]
            out.append(similarity(cells_of([x])[0], cells_b))
        return pd.Series(out, dtype="float64")

    return left.join(right, "b").where(sim("text_a", "text_b") >= threshold).select("a", "b")


def grown(label: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The classes (node, root; roots not listed) ``label`` after new links
    (a, b): only the links are contracted, between the roots known so far."""
    if label is None:
        return components(links)
    for end in ("a", "b"):
        at = label.select(F.col("node").alias(end), F.col("root").alias("_to"))
        links = links.join(at, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    more = components(links)
    if more is None:
        return label
    to = more.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    moved = label.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return stored(moved.union(more), "classes")


def classed(nodes: DataFrame, label: DataFrame | None) -> DataFrame:
    """``nodes`` (column doc_id) with the root of their class."""
    if label is None:
        return nodes.withColumn("class_id", F.col("doc_id"))
    at = label.select(F.col("node").alias("doc_id"), F.col("root").alias("class_id"))
    return nodes.join(at, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))


def cell_counts(members: DataFrame) -> np.ndarray:
    """How many of the members' cells fall on each counter (a fixed number)."""
    def count(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for b in batches:
            texts = list(b["text"])
            for a, z in text_chunks(texts):
                slot = (cells_of(texts[a:z])[0] & np.uint64(len(total) - 1)).astype(np.int64)
                total += np.bincount(slot, minlength=len(total))
        yield pd.DataFrame({"n": [np.minimum(total, 2 ** 32 - 1).astype(np.uint32).tobytes()]})

    def add(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for b in batches:
            for x in b["n"]:
                total += np.frombuffer(x, np.uint32)
        yield pd.DataFrame({"n": [np.minimum(total, 2 ** 32 - 1).astype(np.uint32).tobytes()]})

    total = np.zeros(1 << COUNT_BITS, np.int64)
    for r in members.select("text").mapInPandas(count, "n binary").repartition(8).mapInPandas(add, "n binary").toLocalIterator():
        total += np.frombuffer(r.n, np.uint32)
    return np.minimum(total, 2 ** 32 - 1).astype(np.uint32)


def prefix_table(members: DataFrame, threshold: float) -> DataFrame:
    """The rarest cells of every text, as many as a partner that reaches the
    threshold cannot all miss: n cells, place of the cell in order of rarity."""
    counts = members.sparkSession.sparkContext.broadcast(cell_counts(members).tobytes())

    def run(batches):
        count = np.frombuffer(counts.value, np.uint32)
        for b in batches:
            ids, of, texts = b["doc_id"].to_numpy(), b["class_id"].to_numpy(), list(b["text"])
            for a, z in text_chunks(texts):
                cells, bounds = cells_of(texts[a:z])
                n = np.diff(bounds)
                owner = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((cells, count[(cells & np.uint64(len(count) - 1)).astype(np.int64)], owner))
                at = np.arange(len(cells)) - bounds[:-1][owner]
                on = np.flatnonzero(at <= n[owner] * (1 - threshold) + 1e-6)
                own = owner[on]
                yield pd.DataFrame({"doc_id": ids[a:z][own], "class_id": of[a:z][own], "n": n[own], "at": at[on],
                                    "cell": cells[order][on].view(np.int64)})

    return members.mapInPandas(run, "doc_id long, class_id long, n long, at long, cell long")


def rest_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of all members (doc_id, class_id, text) of different classes that
    may reach the threshold. The first common cell of such a pair lies in both
    prefixes and leaves both texts cells enough for the overlap they need; so
    the shorter text gives only the places that allow a partner as long."""
    rows = stored(prefix_table(members, threshold), "prefixes")
    part = threshold / (1 + threshold)
    left = F.col("n") - F.col("at")
    short = rows.where(left + 1e-6 >= 2 * part * F.col("n")).select(
        "cell", F.col("doc_id").alias("b"), F.col("class_id").alias("of_b"), F.col("n").alias("n_b"), left.alias("left_b"))
    full = rows.select("cell", F.col("doc_id").alias("a"), F.col("class_id").alias("of_a"), F.col("n").alias("n_a"),
                       left.alias("left_a"))
    need = part * (F.col("n_a") + F.col("n_b")) - 1e-6
    on = ((full.cell == short.cell) & (F.col("of_a") != F.col("of_b")) & (F.col("n_b") <= F.col("n_a"))
          & (F.col("left_a") >= need) & (F.col("left_b") >= need))
    return full.join(short, on).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def fetched(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id: the node, text) of nodes (node, key, least): one row each, read
    from the rows of ``docs`` that have this text and the least doc_id."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("text"),
                       F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("_key")).where(F.length("text") > 0)
    on = (rows["_key"] == nodes["key"]) & rows["_id"].eqNullSafe(nodes["least"])
    return (rows.join(nodes, on).dropDuplicates(["_key", "_id"]).select(F.col("node").alias("doc_id"), "text"))


def text_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float,
                 rounds: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Rows with content (doc_id, key), distinct texts (node, key, n rows,
    least doc_id) and the classes of their nodes (node, root)."""
    sig = stored(signature_table(docs, id_col, text_col), "signatures")
    texts = stored(sig.groupBy("key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"),
                                          F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "texts")
    rows = texts.select(F.col("node").alias("doc_id"), F.posexplode("bands").alias("band", "hash"))
    many = stored(rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    rows = stored(rows.join(many, ["band", "hash"]), "buckets")         # members of buckets of two or more
    weight = stored(rows.groupBy("doc_id").agg(F.sum("size").alias("weight")), "weights")
    central = stored(rows.join(weight, "doc_id").groupBy("band", "hash")
                     .agg(F.max_by("doc_id", F.col("weight")).alias("b")), "central")
    nodes = rows.select(F.col("doc_id").alias("node")).distinct().join(texts.select("node", "key", "least"), "node")
    content = stored(fetched(docs, nodes, id_col, text_col), "candidates")

    def mixed(turn):
        """Members of buckets that span several classes, with a hashed pick."""
        named = classed(rows.select("doc_id", "band", "hash"), label)
        order = F.xxhash64("doc_id", "band", F.lit(turn))
        spans = named.groupBy("band", "hash").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"),
                                                  F.max_by("doc_id", order).alias("b"), F.max_by("class_id", order).alias("of"))
        return named.join(stored(spans.where("lo != hi"), "spans"), ["band", "hash"])

    tried, label = None, None
    for turn in range(rounds):
        if not turn:
            pairs = (rows.join(central, ["band", "hash"]).where("doc_id != b")
                     .select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b")).distinct())
        else:
            pairs = (mixed(turn).where("class_id != of")
                     .select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b")).distinct()
                     .join(tried, ["a", "b"], "left_anti"))
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        if not pairs.isEmpty():
            label = grown(label, stored(verified(pairs, content, threshold), "links"))
    rest = mixed(rounds).select("doc_id", "class_id").distinct()
    members = stored(content.join(rest, "doc_id").select("doc_id", "class_id", "text"), "mixed")
    if not members.isEmpty():
        pairs = stored(rest_pairs(members, threshold), "pairs")
        label = grown(label, stored(verified(pairs, content, threshold), "links"))
    return sig.select("doc_id", "key"), texts.drop("bands"), label


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, class_id (least doc_id of its class), kept (doc_id = class_id)
    of every document."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    sig, texts, label = text_classes(docs, "doc_id", "text", threshold, rounds)
    # Texts of several rows, or joined to others; the rest are their own class.
    member = texts.where("n > 1").select("key", "least", F.lit(None).cast("bigint").alias("class_id"))
    if label is not None:
        at = label.union(label.select("root", "root").distinct()).select("node", F.col("root").alias("_root"))
        member = stored(texts.join(at, "node", "left").where("_root is not null or n > 1").select("key", "least", "_root"), "members")
        least = member.where("_root is not null").groupBy("_root").agg(F.min("least").alias("class_id"))
        member = member.join(stored(least, "least"), "_root", "left").select("key", "least", "class_id")
    named = stored(member.select("key", F.coalesce("class_id", "least").alias("class_id")), "named")
    rows = (sig.join(named, "key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
            .union(docs.where(F.coalesce(F.length("text"), F.lit(0)) == 0).select("doc_id", F.col("doc_id").alias("class_id"))))
    rows = stored(rows, "rows")
    out = stored(rows.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.max("class_id").alias("_most")), "documents")
    torn = out.where("class_id != _most").select("doc_id", F.col("class_id").alias("b"))
    if not torn.isEmpty():       # a document whose texts lie in several classes joins them
        merged = least_members(rows.join(torn, "doc_id").select(F.col("class_id").alias("a"), "b"))
        to = stored(merged.select(F.col("node").alias("class_id"), F.col("least").alias("_to")), "merged")
        out = out.join(to, "class_id", "left").withColumn("class_id", F.coalesce("_to", "class_id"))
    return out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """The rows of ``docs``, one of each class of near texts: the one with the
    least doc_id, a null last. Rows without text stay."""
    _, texts, label = text_classes(docs, id_col, text_col, threshold, rounds)
    keep = texts.select("key", "least")
    if label is not None:
        at = label.union(label.select("root", "root").distinct()).select("node", F.col("root").alias("_root"))
        joined = stored(texts.join(at, "node", "left").select("key", "least", "_root"), "members")
        order = F.struct(F.col("least").isNull(), "least", "key")
        first = (joined.where("_root is not null").groupBy("_root").agg(F.min(order).alias("_first"))
                 .select("_first.key", "_first.least"))
        keep = joined.where("_root is null").select("key", "least").union(first)
    key, own = (f"_{uuid.uuid4().hex}" for _ in range(2))
    keep = stored(keep.select(F.col("key").alias(key), F.col("least").alias(own)), "kept")
    text, doc_id = docs[text_col], docs[id_col].cast("bigint")
    rows = docs.select("*", F.unhex(F.md5(text.cast("binary"))).alias(key), doc_id.alias(own))
    on = (rows[key] == keep[key]) & rows[own].eqNullSafe(keep[own])
    kept = rows.join(keep, on, "left_semi").where(F.length(text_col) > 0).dropDuplicates([key, own]).drop(key, own)
    return kept.union(docs.where(F.coalesce(F.length(text_col), F.lit(0)) == 0))
