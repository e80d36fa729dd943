"""Helpers shared by the operators: tables, stored intermediates, word hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_RNG = np.random.RandomState(20240131)


def _odd64(n: int) -> np.ndarray:
    r = _RNG.randint(0, 2 ** 32, size=(n, 2), dtype=np.uint64)
    return (r[:, 0] << np.uint64(32)) | r[:, 1] | np.uint64(1)


BYTE_CODE = _odd64(256)          # a random 64-bit code per byte value
PLACE_CODE = _odd64(1024)        # a random odd multiplier per place in a word
STEP_CODE = _odd64(64)           # a random odd multiplier per place in a shingle
# Word bytes: ASCII letters and digits, and every byte of a non-ASCII character.
WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: computed once, lineage cut, kept when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes (in wrapping arithmetic)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` and each text's bounds in them.

    A word is a run of letters and digits after lower-casing (characters
    beyond ASCII count as letters); null is empty. One pass of array code over
    the joined bytes of all texts, whatever their lengths."""
    parts = [(t or "").lower().encode("utf-8") for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    w = WORD_BYTE[raw]
    edge = np.diff(w.astype(np.int8), prepend=np.int8(0))
    start = np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(parts) + 1, np.int64)
    stop = np.flatnonzero(edge == -1)
    at = np.flatnonzero(w)
    size = stop - start
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    code = BYTE_CODE[raw[at]] * PLACE_CODE[place & 1023]
    hashes = mix64(np.add.reduceat(code, first) + size.astype(np.uint64))
    bounds = np.concatenate([[0], np.searchsorted(start, ends)])
    return hashes, bounds


def text_chunks(texts: list, limit: int = 4 << 20):
    """Ranges [a, b) of a batch whose texts add up to about ``limit``
    characters (one longer text stands alone)."""
    a = total = 0
    for b, t in enumerate(texts):
        n = len(t or "")
        if b > a and total + n > limit:
            yield a, b
            a, total = b, 0
        total += n
    if a < len(texts):
        yield a, len(texts)
