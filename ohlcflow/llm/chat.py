"""Operator 3: chat formatting with an offset-aligned loss mask.

Turns become one string by a template whose marks are control strings; texts
are escaped so that no control string occurs inside them, reversibly. The
whole conversation is encoded once, with character offsets; the sorted spans
of the assistant texts are intersected with the sorted token spans by binary
search, which gives the mask of the tokens a loss is taken over. The marks are
added to the tokenizer as tokens, so a mark never shares a token with a text.

Defined cases: turns are ordered by turn, then role, then text (nulls first);
null text and null role are empty strings; rows with a null conv_id form one
conversation of their own; repeated rows are repeated turns; an empty text has
no tokens; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER, ASSISTANT, SYSTEM = "user", "assistant", "system"
# role -> (mark before, mark after); any other role is written out.
MARKS = {USER: ("[INST]", "[/INST]"), ASSISTANT: ("<s>", "</s>"), SYSTEM: ("<<SYS>>", "<</SYS>>")}
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
CONTROL = [m for pair in MARKS.values() for m in pair] + [ROLE, TEXT, END]

# A control string with any number of backslashes behind its first character.
_FORM = r"([<\[])(\\*)(%s)" % "|".join(sorted((re.escape(c[1:]) for c in CONTROL), key=len, reverse=True))
_ESCAPE = re.compile(_FORM)
_UNESCAPE = re.compile(_FORM.replace(r"(\\*)", r"(\\+)"))
_SPLIT = re.compile("(" + "|".join(sorted(map(re.escape, CONTROL), key=len, reverse=True)) + ")")

FORMATTED = "conv_id string, formatted string, token_ids array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    """One backslash more inside everything that looks like a control string."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def render(turns) -> tuple[str, list[tuple[int, int]]]:
    """(role, text) turns -> the formatted string and the spans of the
    assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        text = escape(text)
        before, after = MARKS.get(role) or (ROLE + escape(role) + TEXT, END)
        at += len(before)
        if role == ASSISTANT:
            spans.append((at, at + len(text)))
        parts += [before, text, after]
        at += len(text) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string: the exact inverse of ``render``."""
    opening = {before: role for role, (before, _) in MARKS.items()}
    pieces, turns, i = _SPLIT.split(formatted), [], 1
    while i < len(pieces):
        if pieces[i] == ROLE:
            turns.append((unescape(pieces[i + 1]), unescape(pieces[i + 3])))
            i += 6
        else:
            turns.append((opening[pieces[i]], unescape(pieces[i + 1])))
            i += 4
    return turns


def load_tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer
    tok = Tokenizer.from_file(path)
    tok.post_processor = None                    # offsets keep leading spaces
    tok.add_tokens([AddedToken(c, normalized=False) for c in CONTROL])
    tok.encode_special_tokens = True             # other special strings are text
    return tok


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """True for tokens that lie in a span: both are sorted, so the first and
    last token of every span come from two binary searches over all spans."""
    mask = np.zeros(len(offsets) + 1, np.int64)
    if len(spans) and len(offsets):
        s = np.array([x for x in spans if x[1] > x[0]], np.int64).reshape(-1, 2)
        first = np.searchsorted(offsets[:, 1], s[:, 0], side="right")
        last = np.searchsorted(offsets[:, 0], s[:, 1], side="left")
        np.add.at(mask, first, 1)
        np.add.at(mask, last, -1)
    return np.cumsum(mask[:-1]) > 0


def conversations(df: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns in order."""
    turn = F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (df.select(F.col("conv_id").cast("string").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns")))


def _long_id(df: DataFrame) -> DataFrame:
    """Ids travel as strings through pandas, where a null would make floats."""
    return df.withColumn("conv_id", F.col("conv_id").cast("bigint"))


def format_chat(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """conv_id, formatted, token_ids, loss_mask of every conversation."""
    def run(batches):
        tok = load_tokenizer(tokenizer_path)
        for b in batches:
            rows = [render([(t["role"], t["text"]) for t in turns]) for turns in b.turns]
            ids, masks = [], []
            for text, spans in rows:             # one text at a time bounds memory
                e = tok.encode(text, add_special_tokens=False)
                ids.append(e.ids)
                masks.append(loss_mask(np.array(e.offsets, np.int64).reshape(-1, 2), spans))
            yield pd.DataFrame({"conv_id": b.conv_id, "formatted": [r[0] for r in rows],
                                "token_ids": ids, "loss_mask": masks})

    return _long_id(conversations(df).mapInPandas(run, FORMATTED))


def masked_texts(token_ids, mask, tok) -> list[str]:
    """The texts under a mask, decoded from its token runs and unescaped."""
    m = np.concatenate([[0], np.asarray(mask, np.int8), [0]])
    edge = np.flatnonzero(np.diff(m))
    return [unescape(tok.decode([int(t) for t in token_ids[a:b]], skip_special_tokens=False))
            for a, b in zip(edge[::2], edge[1::2])]


DIGESTS = ("conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def digests(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Read the output back: turns from the formatted string, the trained-on
    text from the masked tokens."""
    from hashlib import sha256

    def run(batches):
        tok = load_tokenizer(tokenizer_path)
        for b in batches:
            out = []
            for conv, text, ids, mask in zip(b.conv_id, b.formatted, b.token_ids, b.loss_mask):
                turns = parse(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(masked_texts(ids, mask, tok))
                out.append((conv, len(turns), sha256(said.encode()).hexdigest(), len(loss),
                            sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                             "formatted_chars"])

    as_text = formatted.withColumn("conv_id", F.col("conv_id").cast("string"))
    return _long_id(as_text.mapInPandas(run, DIGESTS))
