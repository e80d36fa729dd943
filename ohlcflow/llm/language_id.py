"""Operator 2: language identification by a byte convolutional network.

The UTF-8 bytes of a text are cut into windows of fixed length. Filters of
several widths run over the bytes of a window (a filter is a weight per place
and byte value, so applying it is a table look-up and a sum), each filter's
maximum over the window passes a rectifier, and a softmax layer turns the
maxima into language probabilities. A text's probabilities are the means over
all its windows, weighted by their length.

The network is trained in numpy on a bounded sample of labelled texts: for
every language the ``per_lang`` texts with the smallest id hashes, and up to
``windows_per_text`` windows of each. Prediction sees nothing but the text.

Defined cases: null text, empty text or text without a letter is ``und`` with
score 0; rows without text or language are never learnt from; repeated rows
are predicted alike; with no labelled row at all every text is ``und``; ties
go to the language that sorts first; input columns of any name are kept out
of the result, so none can clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12           # of each width
PER_LANG = 400
WINDOWS_PER_TEXT = 4
EPOCHS = 12
UND = "und"
_LETTER = regex.compile(r"\p{L}")
_BATCH = 1024          # windows in one batch


def windows_of(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as a byte matrix padded by 0, length of each, text of each)."""
    raw = [(t or "").encode("utf-8") for t in texts]
    n = [-(-len(r) // WINDOW) for r in raw]
    flat = b"".join(r + b"\0" * (k * WINDOW - len(r)) for r, k in zip(raw, n))
    owner = np.repeat(np.arange(len(raw)), n)
    size = np.full(len(owner), WINDOW, np.int64)
    for i, end in enumerate(np.cumsum(n)):
        if n[i]:
            size[end - 1] = len(raw[i]) - (n[i] - 1) * WINDOW
    return np.frombuffer(flat, np.uint8).reshape(-1, WINDOW), size, owner


def new_model(langs: list[str], seed: int = 7) -> dict:
    r = np.random.RandomState(seed)
    return {"langs": list(langs), "tables": [r.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
            "bias": np.zeros(FILTERS * len(WIDTHS), np.float32),
            "out": r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32),
            "out_bias": np.zeros(len(langs), np.float32)}


def _maxima(model: dict, x: np.ndarray, where: bool = False):
    """Each filter's maximum over every window (and its place, for training)."""
    top, at = [], []
    for table, w in zip(model["tables"], WIDTHS):
        n = x.shape[1] - w + 1
        y = np.take(table[0], x[:, :n], axis=0)
        for k in range(1, w):
            y += np.take(table[k], x[:, k:k + n], axis=0)
        if where:
            at.append(y.argmax(1))
        top.append(y.max(1))
    return np.concatenate(top, 1) + model["bias"], at


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    """Language probabilities of every window of a byte matrix."""
    out = np.zeros((len(x), len(model["langs"])), np.float64)
    for a in range(0, len(x), 64):               # small steps stay in the cache
        h, _ = _maxima(model, x[a:a + 64])
        out[a:a + 64] = _softmax(np.maximum(h, 0) @ model["out"] + model["out_bias"])
    return out


def train(texts_windows: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 7,
          rate: float = 0.01, batch: int = 128) -> dict:
    """Adam on the cross entropy of windows, classes weighted alike."""
    model = new_model(langs, seed)
    r = np.random.RandomState(seed)
    weight = len(y) / (len(langs) * np.maximum(np.bincount(y, minlength=len(langs)), 1))
    params = [*model["tables"], model["bias"], model["out"], model["out_bias"]]
    mom, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(epochs):
        order = r.permutation(len(y))
        for a in range(0, len(y), batch):
            i = order[a:a + batch]
            x = texts_windows[i]
            h, at = _maxima(model, x, True)
            act = np.maximum(h, 0)
            p = _softmax(act @ model["out"] + model["out_bias"])
            p[np.arange(len(i)), y[i]] -= 1
            dz = (p * weight[y[i]][:, None] / len(i)).astype(np.float32)
            dh = (dz @ model["out"].T) * (h > 0)
            grads = []
            for j, (table, w) in enumerate(zip(model["tables"], WIDTHS)):
                g, d = np.zeros_like(table), dh[:, j * FILTERS:(j + 1) * FILTERS]
                cols = np.broadcast_to(np.arange(FILTERS), d.shape)
                for k in range(w):
                    np.add.at(g[k], (x[np.arange(len(i))[:, None], at[j] + k], cols), d)
                grads.append(g)
            grads += [dh.sum(0), act.T @ dz, dz.sum(0)]
            t += 1
            for prm, g, m, v in zip(params, grads, mom, var):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                prm -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return model


def training_windows(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", per_lang: int = PER_LANG) -> DataFrame:
    """lang, id, place, window: the bounded labelled sample as byte windows.

    Only hashes are ranked (a task hands on ``per_lang`` rows a language at
    most); the last hash chosen of each language then picks the texts in a
    scan, so no text is shuffled. Rows that share an id are chosen together."""
    labelled = docs.where(may_learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()
                          & F.col(id_col).isNotNull())
    rows = labelled.select(F.col(id_col).cast("string").alias("_id"), F.col(lang_col).alias("_lang"),
                           F.xxhash64(F.col(id_col).cast("string")).alias("_h"), F.col(text_col).alias("_text"))
    w = Window.partitionBy("_lang").orderBy("_h")
    reach = (rows.select("_lang", "_h").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_lang)
             .groupBy("_lang").agg(F.max("_h").alias("_top")))       # one row per language
    rows = rows.join(F.broadcast(reach), "_lang").where("_h <= _top")

    def cut(batches):
        for b in batches:
            out = []
            for i, lang, text in zip(b["_id"], b["_lang"], b["_text"]):
                if not _LETTER.search(text):
                    continue
                x, _, _ = windows_of([text])
                step = max(1, len(x) // WINDOWS_PER_TEXT)
                out += [(lang, str(i), k, x[k].tobytes()) for k in range(0, len(x), step)[:WINDOWS_PER_TEXT]]
            yield pd.DataFrame(out, columns=["lang", "id", "place", "window"])

    return rows.mapInPandas(cut, "lang string, id string, place int, window binary")


def fit(docs: DataFrame, may_learn: Column, **columns) -> dict | None:
    """The trained network, or None if there is nothing to learn from."""
    rows = sorted((r.lang, r.id, r.place, bytes(r.window)) for r in
                  training_windows(docs, may_learn, **columns).collect())
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    x = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([langs.index(r[0]) for r in rows]), langs)


def predict_texts(model: dict | None, texts) -> tuple[list[str], np.ndarray]:
    """(language, score) of every whole text, windows batched across texts."""
    texts = list(texts)
    known = [bool(t) and _LETTER.search(t) is not None for t in texts]
    if model is None:
        return [UND] * len(texts), np.zeros(len(texts))
    total = np.zeros((len(texts), len(model["langs"])))
    from .common import text_chunks
    for a, b in text_chunks(texts, 1 << 20):
        x, size, owner = windows_of([t if k else "" for t, k in zip(texts[a:b], known[a:b])])
        if len(x):
            np.add.at(total, owner + a, probabilities(model, x) * size[:, None])
    share = total / np.maximum(total.sum(1, keepdims=True), 1e-300)
    best = share.argmax(1)
    return ([model["langs"][j] if k else UND for j, k in zip(best, known)],
            np.where(known, share[np.arange(len(texts)), best], 0.0).clip(0, 1))


def predictor(model: dict | None):
    """A column function: text -> struct(lang_pred, score)."""
    @F.pandas_udf("lang_pred string, score double")
    def identify(text: pd.Series) -> pd.DataFrame:
        lang, score = predict_texts(model, [None if t is None else t for t in text])
        return pd.DataFrame({"lang_pred": lang, "score": score})
    return identify
