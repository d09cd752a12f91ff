"""Registry of checked queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes (spark, sf_dir) and reads whole driver tables (or views
Spark derives from them). Double columns are rounded to 6 decimals on both
sides so the engines' summation order cannot change the value hash.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
ROUND = 6


def rounded(df: DataFrame) -> DataFrame:
    """Round float/double columns to ROUND decimals (top level only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), ROUND).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT. Wrap each call in a cast."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(tok) - 1
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, _bigint_counts(sql) if sql else None)
        return fn
    return deco


def load_all() -> dict:
    # importing the query modules fills REGISTRY
    from parley.plans import (queries_corpus, queries_io, queries_latency, queries_metrics,  # noqa: F401
                              queries_scores, queries_streaming, queries_vocab)
    return REGISTRY
