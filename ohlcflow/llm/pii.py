"""Operator 6: personal data by patterns and a linear-chain CRF.

Base spans come from four patterns (e-mail, IP address, payment card, phone),
each found in time linear in the text. A linear-chain conditional random field
over word-shape features adds spans the patterns miss: obfuscated e-mail
addresses, local phone numbers, identity numbers, account numbers and secrets
behind a key word. It is trained from a small labelled table (``training_rows``, made
by rule from templates) by maximum likelihood and decoded by Viterbi, both in
numpy over padded batches of lines.

A span may start at any word and covers the whole of an address, its local part
included. Lines are decoded in stretches around words that can belong to a span
(a digit, an "@", a spelt-out "at" or "dot", a key word with a colon or equals
sign), which grow while a span reaches their end. Spans of the field that touch
a base span are dropped; base spans always stay.

Defined cases: null text is empty and has no spans; repeated rows give repeated
results; an empty table gives no rows; offsets count code points, ends are
exclusive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("email", "phone", "id", "account", "secret")
KINDS = BASE + ADDED[2:]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+(?<=[0-9])")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = [int(c) for c in digits[-1::-2]]
    even = [2 * int(c) for c in digits[-2::-2]]
    return (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0


def _emails(text: str):
    at, free = text.find("@"), 0
    before = -1
    while at >= 0:
        low = max(free, before + 1)
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        before, at = at, text.find("@", at + 1)


def _phones(text: str):
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            yield at, m.end()
        at = text.find("+", m.end() if m else at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns, by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _DIGITS.sub("", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", a, b) for a, b in _phones(text)]


# ---------------------------------------------------------------- the field
LABELS = ["O"] + [f"{p}-{k}" for k in ADDED for p in "BI"]
N = len(LABELS)
_WORD = re.compile(r"\S+")
_TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)
# What makes a stretch of a line worth decoding; spans may start at any word.
_SIGN = re.compile(_TRIGGER.pattern + r"|\bdot\b|\b(?:password|passwd|passphrase|secret|token|key)\b\W{0,2}[:=]", re.I)
LOW = -1e4
# Which labels may follow and start: I-x only after B-x or I-x.
ALLOWED = np.array([[not b.startswith("I") or a[2:] == b[2:] for b in LABELS] for a in LABELS])
CUES = ("call", "phone", "tel", "fax", "mail", "email", "contact", "at", "dot", "ssn", "passport", "id", "no",
        "iban", "account", "token", "password", "secret", "key", "api", "write", "reach", "passwd", "passphrase")
FEATURES = 1 << 12
PLACES = 1 << 13         # padded words in one batch of lines


def shape(word: str) -> str:
    """Word shape: digits 9, letters a or A, runs of over two shortened."""
    s = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", "a", re.sub(r"[A-Z]", "A", word.strip(",;:!?"))[:40]).replace("A", "A"))
    return re.sub(r"(.)\1{2,}", r"\1\1+", s)


def _digit_form(word: str) -> str:
    return re.sub(r"[0-9]+", lambda m: f"<{min(len(m[0]), 12)}>", re.sub(r"[^\W\d_]+", "a", word.strip(".,;:!?")))[:32]


def _slot(name: str) -> int:
    return int.from_bytes(hashlib.md5(name.encode()).digest()[:4], "little") % FEATURES


_slots: dict[str, int] = {}


def features(words: list[str]) -> list[list[int]]:
    """Feature numbers of every word, from its shape and its neighbours'."""
    own = []
    for w in words:
        low = w.lower().strip(".,;:!?()[]\"'=")
        own.append((shape(w), _digit_form(w), low if low in CUES else "-", bool(_TRIGGER.search(w))))
    out = []
    for i, (s, d, cue, trig) in enumerate(own):
        names = [f"s:{s}", f"d:{d}", f"c:{cue}", f"t:{trig}"]
        for o in (-3, -2, -1, 1, 2, 3):
            if 0 <= i + o < len(own):
                names += [f"{o}c:{own[i + o][2]}", f"{o}t:{own[i + o][3]}"]
        # Where "at" and "dot" stand around the word.
        around = [own[k][2] if 0 <= k < len(own) else "-" for k in range(i - 3, i + 4)]
        spelt = "".join({"at": "A", "dot": "D"}.get(c, "-") for c in around)
        if "A" in spelt and "D" in spelt:
            names += [f"ad:{spelt}", f"ad:{spelt[2:5]}", f"ad:{spelt[3:]}", f"ad:{spelt[:4]}"]
        for o in (-2, -1, 0):
            if 0 <= i + o:
                names.append(f"{o}e:{words[i + o][-1] if words[i + o][-1] in ':=' else '-'}")
        if i:
            names.append(f"ce:{own[i - 1][2]}{words[i - 1][-1] if words[i - 1][-1] in ':=' else '-'}")
        for o in (-1, 1):
            if 0 <= i + o < len(own):
                names.append(f"{o}d:{own[i + o][1]}")
        row = []
        for x in names:
            if x not in _slots and len(_slots) < 200_000:
                _slots[x] = _slot(x)
            row.append(_slots[x] if x in _slots else _slot(x))
        out.append(row)
    return out


def training_rows(seed: int = 11, n: int = 1500) -> list[list[tuple[str, str]]]:
    """The small labelled table: lines of (word, label), made from templates."""
    r = np.random.RandomState(seed)

    def digits(k):
        return "".join(str(x) for x in r.randint(0, 10, k))

    def hexa(k):
        return "".join("0123456789abcdef"[x] for x in r.randint(0, 16, k))

    def word():
        return "".join("abcdefghijklmnopqrstuvwxyz"[x] for x in r.randint(0, 26, r.randint(2, 9)))

    def pick(options):
        return options[r.randint(0, len(options))]

    forms = {
        "email": lambda: pick([f"{word()} [at] {word()} [dot] com", f"{word()}{digits(2)} (at) {word()} (dot) org",
                               f"{word()} @ {word()} . net", f"{word()}(at){word()}.com",
                               f"{word()}.{word()} [at] {word()} [dot] com", f"{word()} at {word()} dot org",
                               f"{word()}.{word()} at {word()} dot com", f"{word()}_{word()} (at) {word()}.net",
                               f"{word()} at {word()} dot {pick(['com', 'org', 'net', 'de', 'io'])}"]),
        "phone": lambda: pick([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}",
                               f"{digits(3)}.{digits(3)}.{digits(4)}", f"0{digits(3)}/{digits(6)}"]),
        "id": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "account": lambda: pick([f"DE{digits(20)}", f"FR{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)}"]),
        "secret": lambda: pick([hexa(18), f'"{hexa(40)}"', hexa(32), word().title() + "!", word() + digits(2), word(),
                                f"{word()}-{word()}-{digits(2)}", word().title() + digits(4) + "#"]),
    }
    lead = {"email": ["email", "mail", "contact", "write", "write to", "reach", "reach me:", "mail to", ""], "phone": ["call", "tel", "phone", "fax", ""],
            "id": ["ssn", "passport", "id", ""], "account": ["iban", "account", ""],
            "secret": ["token =", "password:", "api key =", "secret =", "key:", "passwd =", "passphrase:", "Password:"]}
    prose = ["met at noon", "look at the dot on it", "a password is needed", "your token expired", "the key to it", "call me",
             "no secret at all", "the account of it", "at last", "mail came late", "write soon", "key: see below the map",
             "contact us at the office", "polka dot dress", "id no longer needed"]
    plain = [lambda: word(), lambda: word().title(), lambda: word() + ",", lambda: digits(r.randint(1, 5)),
             lambda: f"{digits(1)}.{digits(2)}", lambda: f"{digits(4)}-{digits(2)}-{digits(2)}", lambda: f"{digits(2)}:{digits(2)}",
             lambda: f"A{digits(2)}", lambda: f"{digits(3)},{digits(3)}", lambda: digits(16), lambda: f"{digits(2)}.{digits(3)}.{digits(2)}.{digits(2)}",
             lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{word()}.{digits(2)}@{word()}.example.com",
             lambda: word() + digits(1) + word(), lambda: f"{digits(2)}%", lambda: f"${digits(3)}", lambda: "at", lambda: "call"]
    rows = []
    for _ in range(n):
        line: list[tuple[str, str]] = []

        def filler(k):
            for _ in range(k):
                p = plain[0] if r.rand() < 0.6 else pick(plain)
                line.extend((w, "O") for w in (pick(prose) if r.rand() < 0.12 else p()).split())

        filler(r.randint(0, 8))
        if r.rand() < 0.6:
            kind = ADDED[r.randint(0, len(ADDED))]
            line.extend((w, "O") for w in pick(lead[kind]).split())
            words = forms[kind]().split()
            line.extend((w, ("I-" if i else "B-") + kind) for i, w in enumerate(words))
        filler(r.randint(0, 8))
        if line:
            rows.append(line)
    return rows


def _emissions(lines: list[list[str]], weights: np.ndarray):
    """Padded emission scores (lines x places x labels), lengths, features."""
    feats = [features(w) for w in lines]
    size = np.array([len(w) for w in lines])
    e = np.zeros((len(lines), size.max(), N))
    for i, f in enumerate(feats):
        for j, row in enumerate(f):
            e[i, j] = weights[row].sum(0)
    return e, size, feats


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def train(rows=None, epochs: int = 30, rate: float = 0.1, decay: float = 1e-4, batch: int = 64, seed: int = 3) -> dict:
    """Maximum likelihood by AdaGrad; gradients from forward-backward."""
    rows = training_rows() if rows is None else rows
    r = np.random.RandomState(seed)
    w, t = np.zeros((FEATURES, N)), np.zeros((N, N))
    gw2, gt2 = np.full_like(w, 1e-6), np.full_like(t, 1e-6)
    forbid = np.where(ALLOWED, 0.0, LOW)
    start = np.array([LOW if name[0] == "I" else 0.0 for name in LABELS])
    for _ in range(epochs):
        order = r.permutation(len(rows))
        for a in range(0, len(order), batch):
            some = [rows[i] for i in order[a:a + batch]]
            e, size, feats = _emissions([[x for x, _ in line] for line in some], w)
            tr = t + forbid
            b, m = e.shape[:2]
            on = np.arange(m)[None] < size[:, None]
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0] + start
            for j in range(1, m):
                nxt = _log_sum(alpha[:, j - 1, :, None] + tr, 1) + e[:, j]
                alpha[:, j] = np.where(on[:, j, None], nxt, alpha[:, j - 1])
            z = _log_sum(alpha[:, -1], 1)
            for j in range(m - 2, -1, -1):
                prv = _log_sum(tr[None] + (e[:, j + 1] + beta[:, j + 1])[:, None], 2)
                beta[:, j] = np.where(on[:, j + 1, None], prv, 0.0)
            node = np.exp(alpha + beta - z[:, None, None]) * on[..., None]
            gt, gw = np.zeros_like(t), np.zeros_like(w)
            for j in range(1, m):
                edge = np.exp(alpha[:, j - 1, :, None] + tr + (e[:, j] + beta[:, j])[:, None] - z[:, None, None])
                gt -= (edge * on[:, j, None, None]).sum(0)
            for i, line in enumerate(some):
                y = [LABELS.index(label) for _, label in line]
                for j, k in enumerate(y):
                    node[i, j] *= -1
                    node[i, j, k] += 1
                    np.add.at(gw, feats[i][j], node[i, j])
                    if j:
                        gt[y[j - 1], k] += 1
            gw, gt = gw / b - decay * w, gt / b - decay * t
            gw2 += gw * gw
            gt2 += gt * gt
            w += rate * gw / np.sqrt(gw2)
            t += rate * gt / np.sqrt(gt2)
    return {"weights": w, "moves": t + forbid, "start": start}


def viterbi(model: dict, lines: list[list[str]]) -> list[list[str]]:
    """The best labels of every line, all lines of a batch step by step."""
    e, size, _ = _emissions(lines, model["weights"])
    score = e[:, 0] + model["start"]
    back = np.zeros(e.shape, np.int8)
    for j in range(1, e.shape[1]):
        way = score[:, :, None] + model["moves"]
        back[:, j] = way.argmax(1)
        on = (j < size)[:, None]
        score = np.where(on, way.max(1) + e[:, j], score)
    out = []
    for i, n in enumerate(size):
        k, path = int(score[i].argmax()), []
        for j in range(n - 1, -1, -1):
            path.append(LABELS[k])
            k = int(back[i, j, k])
        out.append(path[::-1])
    return out


_REACH = 8


def _parts(words, reach: int = _REACH):
    """(from, to) of the stretches of a line around words with a sign: four
    words on the left, ``reach`` on the right."""
    line = " ".join(w for _, w in words)
    ends = np.cumsum([len(w) + 1 for _, w in words])
    hot = sorted({int(np.searchsorted(ends, m.start(), side="right")) for m in _SIGN.finditer(line)})
    parts, a = [], None
    for j in hot:
        if a is None or j - 4 > b:
            if a is not None:
                parts.append((a, b))
            a = max(0, j - 4)
        b = min(len(words), j + reach + 1)
    return parts + ([(a, b)] if a is not None else [])


def field_spans(model: dict, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans the field finds in whole texts, in stretches of lines around words
    that can belong to one. A stretch whose last word is in a span is decoded
    again, twice as long, until the span ends or the line does."""
    lines, todo, found = [], [], []
    for i, text in enumerate(texts):
        at = -1
        for m in _SIGN.finditer(text):
            if m.start() < at:
                continue
            a = text.rfind("\n", 0, m.start()) + 1
            at = text.find("\n", m.end())
            at = len(text) if at < 0 else at
            words = [(w.start() + a, w[0]) for w in _WORD.finditer(text[a:at])]
            todo += [(len(lines), *part) for part in _parts(words)]
            lines.append((i, words))
    while todo:
        todo.sort(key=lambda x: x[2] - x[1])
        a, again = 0, []
        while a < len(todo):
            b = a + 1                            # stretches of like length, padded, fill a batch
            while b < len(todo) and (b + 1 - a) * (todo[b][2] - todo[b][1]) <= PLACES:
                b += 1
            some, a = todo[a:b], b
            paths = viterbi(model, [[w for _, w in lines[n][1][x:z]] for n, x, z in some])
            for (n, x, z), path in zip(some, paths):
                if path[-1] != "O" and z < len(lines[n][1]):
                    again.append((n, x, min(len(lines[n][1]), z + (z - x))))
                else:
                    found.append((n, x, path))
        todo = again
    out: list[set] = [set() for _ in texts]
    for n, x, path in found:
        i, words = lines[n]
        for j, label in enumerate(path):
            if label[0] == "B":
                k = j + 1
                while k < len(path) and path[k] == "I" + label[1:]:
                    k += 1
                end = words[x + k - 1][0] + len(words[x + k - 1][1].rstrip(".,;:!?"))
                out[i].add((label[2:], words[x + j][0], max(end, words[x + j][0] + 1)))
    return [_apart(sorted(s, key=lambda s: (s[1], -s[2]))) for s in out]


def _apart(spans):
    """Of overlapping spans (of stretches that grew into each other) the first
    and longest, by kind, then start."""
    out = []
    for s in spans:
        if not out or s[1] >= out[-1][2]:
            out.append(s)
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def all_spans(model: dict, texts: list) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text; all: by kind, then start."""
    texts = [t or "" for t in texts]
    out = []
    for text, more in zip(texts, field_spans(model, texts)):
        base = base_spans(text)
        free = [s for s in more if all(s[2] <= b[1] or s[1] >= b[2] for b in base)] if base else more
        out.append((base, sorted(base + free, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


SPAN = "array<struct<kind:string,start:int,end:int>>"


def find(model: dict):
    """A column function: text -> struct(base, spans) of span arrays."""
    from .common import text_chunks

    @F.pandas_udf(f"base {SPAN}, spans {SPAN}")
    def spans(text: pd.Series) -> pd.DataFrame:
        texts, rows = [t for t in text], []
        for a, b in text_chunks(texts, 2 << 20):
            rows += all_spans(model, texts[a:b])
        dicts = [[[dict(kind=k, start=s, end=e) for k, s, e in side] for side in r] for r in rows]
        return pd.DataFrame({"base": [d[0] for d in dicts], "spans": [d[1] for d in dicts]})
    return spans


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping
    spans become one replacement, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redactor(model: dict):
    """A column function: text -> text without personal data (null stays)."""
    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        texts = [t for t in text]
        return pd.Series([None if t is None else redact(t, s) for t, (_, s) in zip(texts, all_spans(model, texts))],
                         dtype=object)
    return clean


def personal_data(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, spans (arrays of kind, start, end) of every document."""
    return (docs.select(F.col(id_col).alias("doc_id"), find(model)(F.col(text_col)).alias("_p"))
            .select("doc_id", "_p.base", "_p.spans"))
