"""Text expressions: tokenising (T2), stop words (T3), n-grams (T4).

All are array expressions evaluated per document on the JVM side, over the
whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stopwords import ENGLISH

# Fixed value: a token is a run of two or more letters, digits or underscores
# (after lower-casing), the default word pattern of the reference vectoriser.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

def english_stop_words() -> tuple:
    """Spark's built-in English stop-word list (the one ``StopWordsRemover``
    loads), kept as a constant so that it needs neither a JVM nor a jar (the
    oracle SQL embeds the same list)."""
    return ENGLISH


def tokenize(text) -> Column:
    """Lower-cased tokens of the whole text, in order."""
    t = text if isinstance(text, Column) else F.col(text)
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_PATTERN), 0)


def add_terms(df: DataFrame, text_col: str = "text", out: str = "terms", stop_words: bool = True,
              ngram_max: int = 1) -> DataFrame:
    """T2-T4 as one array column: tokens, minus stop words, plus bigrams.

    Stop-word removal and bigrams use Spark's ``StopWordsRemover`` and
    ``NGram`` transformers: compiled JVM functions over the token array (array
    lambdas such as ``filter``/``zip_with`` run interpreted and are an order
    of magnitude slower on long texts).
    """
    from pyspark.ml.feature import NGram, StopWordsRemover
    tmp = [f"_{out}_tok", f"_{out}_f", f"_{out}_bi"]
    d = df.withColumn(tmp[0], tokenize(F.col(text_col)))
    cur = tmp[0]
    if stop_words:
        d = StopWordsRemover(inputCol=cur, outputCol=tmp[1], stopWords=list(english_stop_words()),
                             caseSensitive=True).transform(d)
        cur = tmp[1]
    if ngram_max == 1:
        res = F.col(cur)
    elif ngram_max == 2:
        d = NGram(n=2, inputCol=cur, outputCol=tmp[2]).transform(d)
        res = F.concat(F.col(cur), F.col(tmp[2]))
    else:
        raise ValueError("ngram_max must be 1 or 2")
    return d.withColumn(out, res).drop(*[t for t in tmp if t in d.columns])


def sql_tokens(text_sql: str, stop_words: bool = True) -> str:
    """DuckDB twin of tokenize -> remove_stop_words (oracle side)."""
    toks = f"regexp_extract_all(lower({text_sql}), '{TOKEN_PATTERN}')"
    if stop_words:
        lst = ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words())
        toks = f"list_filter({toks}, lambda t: NOT list_contains([{lst}], t))"
    return toks


def sql_terms(list_sql: str, ngram_max: int = 1) -> str:
    """DuckDB twin of ``terms`` over a token list expression."""
    if ngram_max == 1:
        return list_sql
    return f"list_concat({list_sql}, list_transform(range(1, len({list_sql})), lambda i: {list_sql}[i] || ' ' || {list_sql}[i + 1]))"
