"""Operator 8: packing token sequences by minimum bin slack.

Documents become token ids (plus an end id); longer ones are cut into pieces
of the capacity, a shorter piece first. Only the histogram of piece lengths
goes to the driver: at most ``capacity`` entries, whatever the number of
documents. There each step seeds a bin with the longest length left, finds by
a bitset subset-sum program over the available lengths the combination that
leaves the least slack, and takes it as often as the counts allow, so that a
step empties at least one length and steps never exceed ``capacity``. The
plan says which ranks of a length go to which bins; pieces are ranked per
length in small buckets (ranks inside a bucket plus bucket offsets), so no
length, however frequent, is numbered by one task.

Defined cases: null text is empty, and an empty document is one piece holding
the end id; null ids are kept as they are; repeated rows are packed once each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored, text_chunks

CAPACITY = 2048
END_ID = 0
BUCKETS = 64            # least number of rank buckets per length
BUCKET_ROWS = 1 << 20   # pieces of one length to a bucket beyond that
CHUNK = 8 << 20         # characters of texts whose words are encoded together

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long, ids binary"
# A space that is neither after nor before white space starts a token of its
# own, so a text may be cut there; texts with other places are encoded whole.
_UNSAFE = re.compile(r"\s (?:\s|\Z)")


class Encoder:
    """The ids of a byte-level BPE tokenizer file (JSON vocabulary). The
    distinct words of many texts are encoded once, all in one string, and the
    ids of the texts gathered from theirs."""

    def __init__(self, path: str):
        import json

        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.size = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, np.int64)     # bytes of every id
        for token, i in ranks.items():
            self.size[i] = len(token)

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.bpe.encode_to_numpy(text, allowed_special="all"), "<u4")

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, count): of every word with a space before it. Words
        that start or end with white space are encoded alone."""
        odd = [i for i, w in enumerate(words) if not w or w[0].isspace() or w[-1].isspace()]
        alone = [self.ids(" " + words[i]) for i in odd]
        mask = np.ones(len(words), bool)
        mask[odd] = False
        plain = [w for w, m in zip(words, mask) if m]
        ids = self.ids(" " + " ".join(plain)) if plain else np.zeros(0, "<u4")
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in plain), np.int64, len(plain)))
        last = np.searchsorted(np.cumsum(self.size[ids]), ends, side="left") + 1
        first, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        count[mask] = np.diff(last, prepend=0)
        first[mask] = last - count[mask]
        count[odd] = [len(x) for x in alone]
        first[odd] = len(ids) + np.cumsum(count[odd]) - count[odd]
        return np.concatenate([ids, *alone]), first, count

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if _UNSAFE.search(t) or any(s in t for s in self.special)]
        for i in whole:
            out[i] = self.ids(texts[i])
        safe = np.delete(np.arange(len(texts)), whole)
        if not len(safe):
            return out
        split = pc.split_pattern(pa.array([texts[i] for i in safe], pa.large_string()), " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        ids, first, count = self._words(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy()
        start, size = first[code], count[code]
        # The first word of a text has no space before it.
        heads = [self.ids(texts[i][:texts[i].find(" ")] if " " in texts[i] else texts[i]) for i in safe]
        size[bounds[:-1]] = [len(h) for h in heads]
        start[bounds[:-1]] = len(ids) + np.cumsum(size[bounds[:-1]]) - size[bounds[:-1]]
        ids = np.concatenate([ids, *heads])
        stop = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(start - stop[:-1], size) + np.arange(stop[-1])]
        for i, a, z in zip(safe, stop[bounds[:-1]], stop[bounds[1:]]):
            out[i] = flat[a:z]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0].tobytes()


# Fixed value: the word pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for every byte value: bytes
    that print stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first may be shorter."""
    head = n % capacity if n > capacity else n
    out = [(0, head)] if head else []
    return out + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``ids`` holds its ids only ``with_ids``."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        enc = Encoder(tokenizer_path)
        for b in batches:
            docs, texts = list(b["_id"]), [t or "" for t in b["_text"]]
            for a, z in text_chunks(texts, CHUNK):
                out = []
                for doc, own in zip(docs[a:z], enc.encode_all(texts[a:z])):
                    ids = own.tobytes() + end
                    for j, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        part = ids[4 * s:4 * (s + n)]
                        out.append((doc, j, s, n, zlib.crc32(part), part if with_ids else None))
                yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    # Ids travel as strings, so that a null among them makes no floats.
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInPandas(run, PIECES).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The (length, times) combination with the largest sum <= room.

    Bit s of ``reach`` says that sum s can be made; one bitset per length and
    power-of-two bundle is kept for the way back, which takes a length only
    where the sum cannot be made of those before it. Longer lengths come first,
    so short pieces, which fit anywhere, are kept for later bins."""
    steps, reach = [], 1
    full = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, bundle = min(counts[length], room // length), 1
        while left:
            take = min(bundle, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            bundle *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return sorted(used.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, first_bin, per_bin, offset): ranks of
    a length that lie in the range go ``per_bin`` to a bin from first_bin on."""
    left = {n: c for n, c in histogram.items() if c}
    next_rank, next_bin, rows = dict.fromkeys(left, 0), 0, []
    while left:
        seed = max(left)
        rest = {n: c - (n == seed) for n, c in left.items() if c > (n == seed)}
        use = dict(fullest(rest, capacity - seed))
        use[seed] = use.get(seed, 0) + 1
        times = min(left[n] // c for n, c in use.items())
        offset = 0
        for n, c in sorted(use.items(), reverse=True):
            rows.append((n, next_rank[n], next_rank[n] + times * c, next_bin, c, offset))
            next_rank[n] += times * c
            offset += n * c
            left[n] -= times * c
            if not left[n]:
                del left[n]
        next_bin += times
    return rows


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (``length`` column)."""
    counts = {r.length: r.n for r in cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    many = {n: -(-c // BUCKET_ROWS) for n, c in counts.items() if c > BUCKETS * BUCKET_ROWS}
    wide = F.lit(BUCKETS)
    if many:
        wide = F.coalesce(F.create_map(*[F.lit(x) for kv in many.items() for x in kv])[F.col("length")], wide)
    keyed = cut_pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), wide).cast("int"))
    # <= capacity x BUCKETS rows, and one per BUCKET_ROWS pieces beyond that
    sizes = keyed.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n")).toPandas()
    sizes = sizes.sort_values(["length", "_b"])
    sizes["_first"] = sizes.groupby("length")["_n"].cumsum() - sizes["_n"]
    rows = plan(counts, capacity)
    spark = cut_pieces.sparkSession
    first = {(int(a), int(b)): int(c) for a, b, c in zip(sizes["length"], sizes["_b"], sizes["_first"])}
    of: dict[int, np.ndarray] = {}
    for n in {r[0] for r in rows}:
        of[n] = np.array([r[1:] for r in rows if r[0] == n], np.int64)
    shared = spark.sparkContext.broadcast((first, of))   # as small as ``sizes``

    @F.pandas_udf("sequence_id long, offset long")
    def put(length: pd.Series, bucket: pd.Series, rank: pd.Series) -> pd.DataFrame:
        first, of = shared.value
        seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        frame = pd.DataFrame({"n": length.to_numpy(), "b": bucket.to_numpy(), "r": rank.to_numpy()})
        for (n, b), g in frame.groupby(["n", "b"]):
            r, i, table = g.r.to_numpy(np.int64) + first[(n, b)], g.index.to_numpy(), of[n]
            t = table[np.searchsorted(table[:, 0], r, side="right") - 1]
            j = r - t[:, 0]
            seq[i] = t[:, 2] + j // t[:, 3]
            off[i] = t[:, 4] + j % t[:, 3] * n
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    w = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_r", (F.row_number().over(w) - 1).cast("bigint"))
    got = ranked.withColumn("_p", put("length", "_b", "_r"))
    return got.select(*cut_pieces.columns, "_p.sequence_id", "_p.offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False, **columns) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    return place(stored(pieces(docs, tokenizer_path, capacity, with_ids, **columns), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_ids, ids (binary): the packed sequences themselves, from
    a packing made ``with_ids``. A sequence has at most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("_p"))
            .select("sequence_id", "n_ids", F.aggregate("_p", F.lit(b"").cast("binary"),
                                                        lambda a, p: F.concat(a, p["ids"])).alias("ids")))
