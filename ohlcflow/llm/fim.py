"""Operator 13: fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME`` code
points with cumulative counts of units (a run of letters A-Z a-z, or one other
character) and of code points. A cut after k units is found by a binary search
in the counts; only the frames that a cut falls into are decompressed, split
and compressed again, all others pass into the output as they are, in another
order, between small frames that hold the marks. Digests read the output as a
stream, a frame at a time, so no task ever holds a long text unpacked.

The choices of a document depend on its id alone: the first four groups of
eight hex digits of sha256(``1:`` id) give two cuts, form and order.

Defined cases: null text is empty; an empty text, and one that holds a mark,
stays plain; a null id counts as no digits (``1:``); rows are independent, so
repeated rows give repeated results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FRAME = 1 << 16
LEVEL = 1
FIM_PERCENT, SPM_PERCENT = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"      # fixed values
PLAIN, PSM, SPM = "plain", "psm", "spm"

FRAMES = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("n_chars", pa.int64()), ("marked", pa.bool_()),
                    ("unit_from", pa.list_(pa.int64())), ("char_from", pa.list_(pa.int64())),
                    ("carry", pa.list_(pa.bool_())), ("data", pa.list_(pa.binary()))])
OUTPUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                    ("middle_chars", pa.int64()), ("output", pa.list_(pa.binary()))])
FRAMES_SQL = ("doc_id long, n long, n_chars long, marked boolean, unit_from array<long>, char_from array<long>, "
              "carry array<boolean>, data array<binary>")
OUTPUT_SQL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"


def _letters(text: str) -> np.ndarray:
    if text.isascii():
        code = np.frombuffer(text.encode("ascii"), np.uint8)
        return (code | 32) - np.uint8(97) < 26
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return (code | np.uint32(32)) - np.uint32(97) < 26


def unit_starts(text: str, carry: bool) -> np.ndarray:
    """Whether a unit starts at each code point; ``carry``: the character
    before the text is a letter."""
    letter = _letters(text)
    start = ~letter
    start[1:] |= ~letter[:-1]
    if not carry and len(start):
        start[0] = True
    return start


def to_frames(text: str, pack) -> tuple[int, list, list, list, list]:
    """(units, units before, code points before, carry, data) of the frames."""
    units, carry = 0, False
    unit_from, char_from, carries, data = [], [], [], []
    for a in range(0, len(text), FRAME):
        part = text[a:a + FRAME]
        unit_from.append(units)
        char_from.append(a)
        carries.append(carry)
        data.append(pack(part.encode("utf-8", "surrogatepass")))
        units += int(np.count_nonzero(unit_starts(part, carry)))
        carry = part[-1].isascii() and part[-1].isalpha()
    return units, unit_from, char_from, carries, data


def frames(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The frame store: one row per row of ``docs``."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in batches:
            out = []
            for doc, text in zip(b.column("_id"), b.column("_text")):
                text = text.as_py() or ""
                units, *lists = to_frames(text, pack)
                out.append((doc.as_py(), units, len(text), any(m in text for m in (PREFIX, SUFFIX, MIDDLE)), *lists))
            yield _batch(out, FRAMES)

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, FRAMES_SQL)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def choices(doc: int | None, n: int, marked: bool) -> tuple[str, int, int]:
    """(form, units of the prefix, units of prefix and middle)."""
    digits = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= FIM_PERCENT:
        return PLAIN, a, b
    return (SPM if h4 % 100 < SPM_PERCENT else PSM), a, b


class Store:
    """The frames of one text, for seeking."""

    def __init__(self, n, n_chars, unit_from, char_from, carry, data, pack, unpack):
        self.n, self.n_chars, self.carry, self.data = n, n_chars, carry, data
        self.unit_from, self.char_from = np.array(unit_from, np.int64), np.array(char_from, np.int64)
        self.pack, self.unpack = pack, unpack

    def text(self, i: int) -> str:
        return self.unpack(self.data[i]).decode("utf-8", "surrogatepass")

    def char_of(self, k: int) -> int:
        """The number of code points in the first k units."""
        if k >= self.n:
            return self.n_chars
        i = int(np.searchsorted(self.unit_from, k, side="right")) - 1
        start = np.flatnonzero(unit_starts(self.text(i), self.carry[i]))
        return int(self.char_from[i] + start[k - self.unit_from[i]])

    def part(self, a: int, b: int) -> list[bytes]:
        """Frames of the code points from a to b; only cut ones are unpacked."""
        out = []
        if a >= b:
            return out
        for i in range(int(np.searchsorted(self.char_from, a, side="right")) - 1, len(self.data)):
            lo = int(self.char_from[i])
            hi = int(self.char_from[i + 1]) if i + 1 < len(self.data) else self.n_chars
            if lo >= b:
                break
            if a <= lo and hi <= b:
                out.append(self.data[i])
            else:
                out.append(self.pack(self.text(i)[max(a, lo) - lo:min(b, hi) - lo].encode("utf-8", "surrogatepass")))
        return out


def fill_in_middle(store: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (frames in the
    order of the output) of every row of a frame store."""
    def run(batches):
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress
        mark = {m: pack(m.encode()) for m in (PREFIX, SUFFIX, MIDDLE)}
        for b in batches:
            out = []
            for r in b.to_pylist():
                form, x, y = choices(r["doc_id"], r["n"], r["marked"])
                if form == PLAIN:
                    out.append((r["doc_id"], r["n"], form, None, None, r["data"]))
                    continue
                s = Store(r["n"], r["n_chars"], r["unit_from"], r["char_from"], r["carry"], r["data"], pack, unpack)
                p, q = s.char_of(x), s.char_of(y)
                prefix = [mark[PREFIX], *s.part(0, p)]
                suffix = [mark[SUFFIX], *s.part(q, s.n_chars)]
                middle = [mark[MIDDLE], *s.part(p, q)]
                first = prefix + suffix if form == PSM else suffix + prefix
                out.append((r["doc_id"], r["n"], form, p, q - p, first + middle))
            yield _batch(out, OUTPUT)

    return store.mapInArrow(run, OUTPUT_SQL)


def restore(output: list[bytes], form: str, unpack):
    """The original text of an output as a stream of UTF-8 parts: a first pass
    finds the marks, a second reads the parts between them in their order."""
    if form == PLAIN:
        yield from map(unpack, output)
        return
    marks = [m.encode() for m in ((PREFIX, SUFFIX, MIDDLE) if form == PSM else (SUFFIX, PREFIX, MIDDLE))]
    found, starts, at, tail = [], [], 0, b""
    for frame in output:
        data = unpack(frame)
        starts.append(at)
        window, base, seek = tail + data, at - len(tail), 0
        while len(found) < 3 and (i := window.find(marks[len(found)], seek)) >= 0:
            found.append(base + i)
            seek = i + 3
        at += len(data)
        tail = window[max(seek, len(window) - 2):]
    parts = dict(zip(marks, ((a + 3, b) for a, b in zip(found, found[1:] + [at]))))
    starts = np.array(starts + [at])
    for m in (PREFIX, MIDDLE, SUFFIX):
        a, b = parts[m.encode()]
        i = int(np.searchsorted(starts, a, side="right")) - 1
        while a < b:
            if starts[i + 1] > a:
                yield unpack(output[i])[a - starts[i]:b - starts[i]]
                a = int(starts[i + 1])
            i += 1


def text_of(output: list[bytes], unpack) -> bytes:
    return b"".join(map(unpack, output))


def digests(filled: DataFrame) -> DataFrame:
    """The output of ``fill_in_middle`` with digests in place of the frames:
    of the output, and of the text rebuilt from output and form."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            output, restored = [], []
            for frames_of, form in zip(b.column("output"), b.column("form")):
                data = frames_of.as_py()
                one, two = hashlib.sha256(), hashlib.sha256()
                for f in data:
                    one.update(unpack(f))
                for part in restore(data, form.as_py(), unpack):
                    two.update(part)
                output.append(one.hexdigest())
                restored.append(two.hexdigest())
            keep = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(output, pa.string()),
                                             pa.array(restored, pa.string())], names=keep + ["output_sha256", "restored_sha256"])

    return filled.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                  "output_sha256 string, restored_sha256 string")


def frame_store(docs: DataFrame, **columns) -> DataFrame:
    """The frames of all texts, written to the shared folder."""
    return stored(frames(docs, **columns), "frames")
