"""Operator 4, host-level quality rules.

1. Each text's counts come from one Arrow-batched function; the document rules are ``too_short`` (fewer than 50 words) and
   ``repetitive`` (over half of the words stand in a 3-word window found twice or more in the text).
2. Failures of each rule are summed by host in Spark (partial sums before the shuffle; one row for each host).
3. An empirical beta prior is fitted to the hosts' rates by moments, and each host's rate is shrunk to
   (failures + a) / (documents + a + b). A host whose shrunk rate of a rule exceeds ``max_rate`` is rejected.
4. Host verdicts are joined back: a document stays if it passes the rules itself and its host is not rejected.

Null text has no words and fails ``too_short``. Null hosts form one host. Repeated rows count as often as they occur. With one host,
or hosts of equal rates, the prior's strength is ``MAX_STRENGTH`` documents. Extra columns are kept by ``filter_documents``.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C
from parley.session import scratch_path

MIN_WORDS = 50
MAX_RATE = 0.8
MAX_STRENGTH = 1000.0
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RULES = ["too_short", "repetitive"]
BROADCAST_ROWS = 100_000


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    w = text.encode().split()  # bytes split at ASCII white space only
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            seen.add(line)
    dup = lines - len(seen)
    grams = list(zip(w, w[1:], w[2:], strict=False))
    first: dict[tuple, int] = {}
    covered = bytearray(len(w))
    for i, g in enumerate(grams):
        at = first.setdefault(g, i)
        if at != i:
            covered[i:i + 3] = b"\1\1\1"
            covered[at:at + 3] = b"\1\1\1"
    return len(w), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, sum(covered)


def _counts(text: Column) -> Column:
    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    def counts(texts: pd.Series) -> pd.DataFrame:
        C.worker_tables("quality")
        return pd.DataFrame([text_counts(t) for t in texts], columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
    return counts(text)


def rule(name: str, m: Column) -> Column:
    if name == "too_short":
        return m["n_words"] < MIN_WORDS
    return m["n_repeat_words"] * 100 > m["n_words"] * 50


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, n_docs, <rule>_rate, host_rejected): shrunk failure rates of each host, from rows with host and m."""
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *[F.sum(rule(r, F.col("m")).cast("long")).alias(r) for r in RULES]).checkpoint()
    moments = hosts.agg(F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("h"), *[x for r in RULES for x in (
        F.sum(r).alias(f"{r}_sum"), F.var_pop(F.col(r) / F.col("n_docs")).alias(f"{r}_var"))], F.avg(1 / F.col("n_docs")).alias("inv")).first()
    out = hosts
    rejected = F.lit(False)
    for r in RULES:
        mean = ((moments[f"{r}_sum"] or 0) + 0.5) / ((moments["n"] or 0) + 1)
        inv, spread = moments["inv"] or 1.0, moments[f"{r}_var"] or 0.0
        between = (spread - mean * (1 - mean) * inv) / max(1 - inv, 1e-9)  # variance of true rates, sampling noise taken off
        strength = min(MAX_STRENGTH, max(1.0, mean * (1 - mean) / between - 1)) if between > 0 else MAX_STRENGTH
        out = out.withColumn(f"{r}_rate", (F.col(r) + mean * strength) / (F.col("n_docs") + strength))
        rejected = rejected | (F.col(f"{r}_rate") > max_rate)
    return out.withColumn("host_rejected", rejected).drop(*RULES)


def _joined(measured: DataFrame, counted: DataFrame, max_rate: float) -> DataFrame:
    verdicts = host_verdicts(counted, max_rate).select(F.col("host").alias("__host"), "host_rejected")
    near = C.small_side(verdicts, BROADCAST_ROWS)
    return measured.join(near, F.col("host").eqNullSafe(F.col("__host")), "left").drop("__host")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """doc_id, the five counts, base_failed, host_rejected and kept of each row of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    m = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), _counts(text).alias("m")).checkpoint()
    failed = rule("too_short", F.col("m")) | rule("repetitive", F.col("m"))
    return _joined(m, m, max_rate).select("doc_id", "m.*", failed.alias("base_failed"), "host_rejected", (~failed & ~F.col("host_rejected")).alias("kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were. Rows are measured once and written beside their counts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = scratch_path(docs.sparkSession, "quality")
    docs.select(F.struct(*docs.columns).alias("row"), F.col(host_col).alias("host"), _counts(text).alias("m")).write.parquet(path)
    measured = docs.sparkSession.read.parquet(path)
    failed = rule("too_short", F.col("m")) | rule("repetitive", F.col("m"))
    return _joined(measured, measured.select("host", "m"), max_rate).filter(~failed & ~F.col("host_rejected")).select("row.*")
