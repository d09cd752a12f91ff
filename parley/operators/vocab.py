"""Token statistics and budgeted vocabulary selection.

AG1 token frequency, SK1-SK3 keep set, W4 dense id map, W5 cumulative
coverage, AG4-AG7 coverage and audit reports, SO1/SO2/J4 set logic.
All tables here are vocabulary-sized (one row per token id) except the
token stream feeding AG1, which is counted by Arrow batch (or reduced by a partial
hash aggregate) before the final aggregate.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.tokenize import Tokenizer
from parley.operators.common import global_index


# ---------------------------------------------------------------- IO14 / AG1
def both_sides(directed: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """IO14: every src and every tgt becomes one text row."""
    return directed.select(F.explode(F.array(F.col(src), F.col(tgt))).alias("text"))


def counted_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and how often each is there: by a table where it is no longer than the ids, else by a sort."""
    if not len(ids) or int(ids.max()) >= len(ids):
        return np.unique(ids, return_counts=True)
    n = np.bincount(ids)
    return np.flatnonzero(n), n[n > 0]


def _counts(flat):
    """(token_id, n) of each Arrow batch of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n = counted_ids(flat(b.column(0))[0])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(n, pa.int64())], ["token_id", "n"])
    return run


def token_freq(texts: DataFrame, tok: Tokenizer, text_col: str = "text") -> DataFrame:
    """AG1: (token_id int, freq bigint) over all texts, on a batch or a stream; counted by batch where the tokenizer allows."""
    if tok.flat is not None:
        counts = texts.select(F.col(text_col).cast("string")).mapInArrow(_counts(tok.flat), "token_id int, n bigint")
        return counts.groupBy("token_id").agg(F.sum("n").alias("freq"))
    ids = texts.select(F.explode(tok.encode(F.col(text_col))).alias("token_id"))
    return ids.groupBy("token_id").agg(F.count(F.lit(1)).alias("freq"))


def ids_table(spark: SparkSession, ids: Sequence[int]) -> DataFrame:
    return spark.createDataFrame([(int(i),) for i in ids], "token_id int")


# ---------------------------------------------------------------- SK1 / SO1 / J4
def select_keep(freq: DataFrame, special: DataFrame, max_vocab: int,
                force: DataFrame | None = None) -> DataFrame:
    """SK1: special and forced ids always kept, then top-frequency fill up to ``max_vocab``.

    Returns (token_id, reason) with reason in {special, force, fill}; an id both
    special and forced is tagged special. Fill ranks by freq desc, token_id asc
    (deterministic tie rule). When special + forced already reach the budget,
    nothing is filled and the result may exceed ``max_vocab``.
    """
    keep0 = special.select("token_id", F.lit(0).alias("_r"))
    if force is not None:
        keep0 = keep0.unionByName(force.select("token_id", F.lit(1).alias("_r")))
    keep0 = keep0.groupBy("token_id").agg(F.min("_r").alias("_r")).select(
        "token_id", F.when(F.col("_r") == 0, "special").otherwise("force").alias("reason"))  # SO1
    keep0 = keep0.checkpoint(eager=True)   # vocabulary-sized; counted and reused below
    remaining = max_vocab - keep0.count()
    if remaining <= 0:
        return keep0
    cand = freq.join(keep0.select("token_id"), "token_id", "left_anti")  # J4
    fill = cand.orderBy(F.col("freq").desc(), F.col("token_id").asc()).limit(remaining)
    return keep0.unionByName(fill.select("token_id", F.lit("fill").alias("reason")))


def vocab_map(keep: DataFrame) -> DataFrame:
    """Dense new ids 0..n-1 in ascending old id order: (old_id, new_id)."""
    idx = global_index(keep.select("token_id"), ["token_id"], name="new_id")
    return idx.select(F.col("token_id").alias("old_id"), F.col("new_id").cast("int").alias("new_id"))


def build_keep_ids(freq: DataFrame, special: DataFrame, max_vocab: int,
                   force: DataFrame | None = None) -> DataFrame:
    """SK2: keep ids with their dense new ids (ascending old id order)."""
    return vocab_map(select_keep(freq, special, max_vocab, force))


def keep_policy(corpus_texts: DataFrame, calib_texts: DataFrame | None, special: DataFrame,
                max_vocab: int, tok: Tokenizer):
    """SK3: every corpus token is forced; calibration frequency only fills the rest.

    Returns (keep_tagged, force_ids).
    """
    force = token_freq(corpus_texts, tok).select("token_id")
    if calib_texts is None:
        fill = force.limit(0).withColumn("freq", F.lit(0).cast("bigint"))
    else:
        fill = token_freq(calib_texts, tok)
    return select_keep(fill, special, max_vocab, force), force


# ---------------------------------------------------------------- AG7
def keep_report(keep: DataFrame, special: DataFrame, force: DataFrame, max_vocab: int) -> DataFrame:
    """AG7: special, forced, kept, target, reserve = max(0, kept - |force u special|)."""
    tagged = (keep.select("token_id", F.lit("k").alias("t"))
              .unionByName(special.select("token_id", F.lit("s").alias("t")))
              .unionByName(force.select("token_id", F.lit("f").alias("t"))))
    per_id = tagged.groupBy("token_id").agg(
        F.max(F.col("t") == "k").alias("k"), F.max(F.col("t") == "s").alias("s"),
        F.max(F.col("t") == "f").alias("f"))
    r = per_id.agg(F.count_if("s").alias("special"), F.count_if("f").alias("forced"),
                   F.count_if("k").alias("kept"), F.count_if(F.col("s") | F.col("f")).alias("_sf"))
    return r.select("special", "forced", "kept", F.lit(max_vocab).alias("target"),
                    F.greatest(F.lit(0).cast("bigint"), F.col("kept") - F.col("_sf")).alias("reserve"))


# ---------------------------------------------------------------- AG4 / AG5 / W5
def coverage(rows: DataFrame, freq: DataFrame, budget: int) -> DataFrame:
    """AG4: corpus rows, total tokens, unique tokens, whether unique fits the budget."""
    tagged = (rows.select(F.lit(True).alias("_row"), F.lit(None).cast("bigint").alias("freq"))
              .unionByName(freq.select(F.lit(False).alias("_row"), F.col("freq").cast("bigint"))))
    r = tagged.agg(F.count_if("_row").alias("rows"),
                   F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("total_tokens"),
                   F.count_if(~F.col("_row")).alias("unique_tokens"))
    return r.select("rows", "total_tokens", "unique_tokens",
                    (F.col("unique_tokens") <= budget).alias("fits_budget"))


def cumulative_coverage(freq: DataFrame) -> DataFrame:
    """(token_id, freq, rank, cum_freq, cum_share) by descending frequency (rank 0-based)."""
    r = global_index(freq, [F.col("freq").desc(), F.col("token_id").asc()], name="rank",
                     running_sum="freq", running_name="cum_freq", total_name="_t")
    return r.select("token_id", "freq", "rank", F.col("cum_freq").cast("bigint").alias("cum_freq"),
                    (F.col("cum_freq") / F.greatest(F.lit(1), F.col("_t"))).alias("cum_share"))


def topn_coverage(freq: DataFrame, ns: Sequence[int] = (50000, 80000, 100000, 110000)) -> DataFrame:
    """AG5: for each N, covered share of the top N, tail token count, tail share (percent).

    One pass over the ranked table with a conditional sum per N.
    """
    r = global_index(freq, [F.col("freq").desc(), F.col("token_id").asc()], name="rank")
    aggs = [F.coalesce(F.sum("freq"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("uniq")]
    aggs += [F.coalesce(F.sum(F.when(F.col("rank") < n, F.col("freq"))), F.lit(0)).alias(f"c{i}")
             for i, n in enumerate(ns)]
    one = r.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(int(n)).alias("top_n"), F.col(f"c{i}").alias("covered"))
                     for i, n in enumerate(ns)])
    ex = one.select("total", "uniq", F.inline(rows))
    den = F.greatest(F.lit(1), F.col("total"))
    return ex.select("top_n", F.col("covered").cast("bigint").alias("covered_tokens"),
                     (F.lit(100.0) * F.col("covered") / den).alias("covered_pct"),
                     F.greatest(F.lit(0).cast("bigint"), F.col("uniq") - F.col("top_n")).alias("tail_tokens"),
                     (F.lit(100.0) * (F.lit(1.0) - F.col("covered") / den)).alias("tail_pct"))


# ---------------------------------------------------------------- AG6 / SO2
def map_audit(keep_ids: DataFrame, used_ids: DataFrame) -> DataFrame:
    """AG6: keep size, kept-but-unused (with share of keep), used-but-missing.

    An empty keep set gives a null share instead of a division error.
    """
    k = keep_ids.select("token_id").distinct().select("token_id", F.lit(True).alias("k"))
    u = used_ids.select("token_id").distinct().select("token_id", F.lit(True).alias("u"))
    j = k.join(u, "token_id", "full_outer")
    r = j.agg(F.count_if(F.col("k")).alias("keep_size"),
              F.count_if(F.col("k") & F.col("u").isNull()).alias("kept_unused"),
              F.count_if(F.col("u") & F.col("k").isNull()).alias("used_missing"),
              F.count_if(F.col("u")).alias("used_size"))
    return r.select("keep_size", "used_size", "kept_unused", "used_missing",
                    F.when(F.col("keep_size") > 0, F.lit(100.0) * F.col("kept_unused") / F.col("keep_size"))
                    .alias("kept_unused_pct"))


def minus(a: DataFrame, b: DataFrame, col: str = "token_id") -> DataFrame:
    """SO2: ids of ``a`` absent from ``b``."""
    return a.select(col).distinct().join(b.select(col), col, "left_anti")
