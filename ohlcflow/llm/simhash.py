"""Operator 12: SimHash near-duplicates by meet-in-the-middle ball hashing.

A text becomes a 64-bit fingerprint of its three-word shingles. Fingerprints
that differ in at most ``RADIUS`` = 2 bits lie within 1 bit of some common
point, so every distinct fingerprint emits itself and its 64 one-bit variants;
equal variants meet in one shuffle. Distinct fingerprints at one point are at
most 65, whatever the table, and all lie within two bits of each other, so one
link from each to the one before it in the point's order joins them all: no
pairs are emitted within a point. Links are deduplicated, verified by counting
the differing bits, and contracted to components. Equal fingerprints are one
node from the start, so copies, however many, take no part in the search.

Words are runs of characters other than space and \\t \\n \\v \\f \\r; only A-Z are
lower-cased. Fewer than three words make one shingle of all of them.

Defined cases: a text without words (null, empty, white space) has fingerprint
zero and is linked like any other; every row is listed, repeated rows as often
as they occur; a row without a doc_id is listed with its fingerprint, and its
component is named by the least doc_id reachable (null if there is none); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from xxhash import xxh64_intdigest

from .common import stored
from .components import components

SEED = 42
BITS = 64
RADIUS = 2
STEP = 1 << 16                 # shingles whose bits are counted at once
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None) -> int:
    """The SimHash of a text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < 3:
        return xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - 2
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, zip(words, words[1:], words[2:])), repeat(SEED)),
                         "<u8", n)
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, STEP):
        ones += np.unpackbits(hashes[a:a + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in b.column("_text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``nodes`` (column fp)
    that connect all within ``RADIUS`` bits."""
    masks = [0] + [1 << i for i in range(BITS - 1)] + [-(1 << (BITS - 1))]
    ball = nodes.select("fp", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("m"))
    point = ball.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))
    before = F.lag("fp").over(Window.partitionBy("point").orderBy("fp"))
    pairs = point.select(F.col("fp").alias("a"), before.alias("b")).where("b is not null").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    roots = components(links(nodes))
    if roots is None:
        named = nodes.where("n > 1").select("fp", F.col("least").alias("component_id"))
    else:
        # Root and least doc_id of every fingerprint that is joined to another.
        all_roots = roots.union(roots.select("root", "root").distinct())
        member = stored(nodes.join(all_roots.withColumnRenamed("node", "fp"), "fp", "left")
                        .where("root is not null or n > 1").select("fp", "root", "least"), "members")
        least = stored(member.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id")), "least")
        named = member.join(least, "root", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    named = stored(named, "named")
    return prints.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"))
