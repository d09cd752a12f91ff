"""Corpus quality profile by direction (PF8-PF14, AG2) and bad samples."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import cut, has_cjk, is_punct_only, strip_ws, word_count
from parley.operators.common import top_n_per_group

# The six metric names of the profile, in report order.
METRICS = ["empty_tgt", "punct_only_tgt", "ultrashort_tgt", "tgt_not_zh", "tgt_has_cjk", "src_eq_tgt"]


def _inputs(src: str, tgt: str, direction: str):
    return (F.coalesce(F.col(src), F.lit("")), F.coalesce(F.col(tgt), F.lit("")),
            F.coalesce(F.col(direction), F.lit("?")))


def metric_flags(src: str = "src", tgt: str = "tgt", direction: str = "direction") -> dict[str, Column]:
    """PF9-PF14 as boolean columns over a directed row."""
    s, t, d = _inputs(src, tgt, direction)
    ts, ss = strip_ws(t), strip_ws(s)
    empty = F.length(ts) == 0
    return {
        "empty_tgt": empty,                                                        # PF10
        "punct_only_tgt": is_punct_only(t),                                        # PF9
        "ultrashort_tgt": F.when(d.endswith("2zh"), F.length(ts) <= 1)
                           .otherwise(word_count(t) <= 1),                         # PF14
        "tgt_not_zh": d.endswith("2zh") & ~empty & ~has_cjk(t),                   # PF11
        "tgt_has_cjk": d.endswith("2en") & has_cjk(t),                             # PF12
        "src_eq_tgt": (ss == ts) & (F.length(ss) > 0),                             # PF13
    }


def quality_profile(df: DataFrame, src: str = "src", tgt: str = "tgt", direction: str = "direction",
                    total_label: str = "__all__") -> DataFrame:
    """AG2: one hash aggregate over all metrics; ``rollup`` adds the total row.

    Columns: direction, n, tgt_chars, the six counters, avg_tgt_chars and one
    ``pct_<metric>`` per counter (100 * c / max(1, n)).
    """
    _, t, d = _inputs(src, tgt, direction)
    flags = metric_flags(src, tgt, direction)
    base = df.select(d.alias("direction"), F.length(strip_ws(t)).alias("_tlen"),
                     *[v.alias(k) for k, v in flags.items()])
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("_tlen").cast("bigint").alias("tgt_chars")]
    aggs += [F.count_if(F.col(m)).alias(m) for m in METRICS]
    g = base.rollup("direction").agg(*aggs, F.grouping("direction").alias("_g"))
    den = F.greatest(F.lit(1), F.col("n"))
    out = g.select(F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col("direction")).alias("direction"),
                   "n", F.coalesce("tgt_chars", F.lit(0)).cast("bigint").alias("tgt_chars"), *METRICS,
                   (F.col("tgt_chars") / den).alias("avg_tgt_chars"),
                   *[(F.lit(100.0) * F.col(m) / den).alias(f"pct_{m}") for m in METRICS])
    return out


def bad_samples(df: DataFrame, n: int, order_by: Sequence, src: str = "src", tgt: str = "tgt",
                direction: str = "direction", width: int = 60, salt_buckets: int | None = None) -> DataFrame:
    """First ``n`` rows per problem tag across directions, values cut to ``width``.

    Ultra-short rows are counted in the profile but never sampled.
    """
    flags = metric_flags(src, tgt, direction)
    tags = [m for m in METRICS if m != "ultrashort_tgt"]
    tag_arr = F.filter(F.array(*[F.when(flags[m], F.lit(m)) for m in tags]), lambda x: x.isNotNull())
    rename = {direction: "_d", src: "_s", tgt: "_t"}
    extra = [c for c in order_by if c not in rename]
    ex = df.select(*extra, F.coalesce(F.col(direction), F.lit("?")).alias("_d"),
                   F.coalesce(F.col(src), F.lit("")).alias("_s"),
                   F.coalesce(F.col(tgt), F.lit("")).alias("_t"),
                   F.explode(tag_arr).alias("tag"))
    order = [rename.get(c, c) for c in order_by]
    top = top_n_per_group(ex, ["tag"], order, n, rank_col="rank", salt_buckets=salt_buckets)
    return top.select("tag", "rank", *extra, F.col("_d").alias("direction"),
                      cut("_s", width).alias("src"), cut("_t", width).alias("tgt"))
