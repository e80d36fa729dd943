"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each Spark builder takes (spark, sf_dir) and reads the driver's tables whole.
Doubles are rounded to 6 places on both sides so results compare exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


REGISTRY: dict = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle comparison rule)."""
    scale = float(10 ** digits)
    return df.select(*[(F.round(F.col(f.name) * F.lit(scale)) / F.lit(scale)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def expand_r6(sql: str) -> str:
    """Rewrite ``R6(expr)`` to the SQL twin of ``rounded``: scale, round half
    away from zero, unscale (identical doubles in both engines)."""
    out, i = [], 0
    while True:
        j = sql.find("R6(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = expand_r6(sql[j + 3:k - 1])
        out.append(f"(ROUND(({inner}) * 1000000.0) / 1000000.0)")
        i = k


def register(name: str, sql=None):
    """Register a builder with its oracle: SQL text, or a function giving it."""
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def oracle_of(name: str) -> str | None:
    """The DuckDB text of a query, built when it is asked for: a bad oracle
    fails alone and never the import of the registry."""
    sql = REGISTRY[name][1]
    return expand_r6(sql() if callable(sql) else sql) if sql else None


