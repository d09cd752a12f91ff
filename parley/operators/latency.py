"""Simultaneous-translation latency: wait-k delays (SQ12), Average Lagging
(AG17), LAAL (ST7), wait-k training pairs (ST1) and sampled k (ST2).
All row-local array expressions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def waitk_delays(src_len, tgt_len, k) -> Column:
    """SQ12: g(i) = min(k + i, S) for i in 0..T-1 (T = 0 gives [])."""
    s, t, kk = _c(src_len), _c(tgt_len), _c(k) if not isinstance(k, int) else F.lit(k)
    return F.when(t <= 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.sequence(F.lit(0), t - 1), lambda i: F.least(kk + i, s)))


def _lagging(delays, src_len, tgt_len, ratio) -> Column:
    g, s, t = _c(delays), _c(src_len), _c(tgt_len)
    hit = F.array_position(F.transform(g, lambda x: x >= s), True)
    tau = F.coalesce(F.nullif(hit, F.lit(0)), t.cast("long"))
    total = F.aggregate(F.transform(F.slice(g, 1, tau.cast("int")), lambda x, i: x - i / ratio), F.lit(0.0),
                        lambda a, x: a + x)
    return (F.when((t == 0) | (s == 0), F.lit(0.0))
            .when(F.size(g) < tau, F.lit(None).cast("double"))
            .otherwise(total / tau))


def average_lagging(delays, src_len, tgt_len) -> Column:
    """AG17: AL = (1/tau) * sum_{i<tau} (g_i - i / r), r = T / S, tau = first 1-based i with g >= S.

    0.0 when either length is 0; null when the delays are shorter than tau.
    """
    return _lagging(delays, src_len, tgt_len, _c(tgt_len) / _c(src_len))


def laal(delays, src_len, hyp_len, ref_len) -> Column:
    """ST7: length-adaptive AL, r = max(hyp_len, ref_len) / S."""
    return _lagging(delays, src_len, hyp_len, F.greatest(_c(hyp_len), _c(ref_len)) / _c(src_len))


def waitk_pairs(df: DataFrame, key: str, src_units: str, tgt_units: str, k: str,
                with_text: bool = False, src_sep: str = " ", tgt_sep: str = "") -> DataFrame:
    """ST1: for each target index i, the source prefix of g(i) units and the target
    prefix of i + 1 units. Prefix lengths by default (output linear in T);
    ``with_text`` also materializes the prefix strings."""
    g = waitk_delays(F.size(src_units), F.size(tgt_units), F.col(k))
    z = F.arrays_zip(g.alias("g"), F.col(tgt_units).alias("u"))
    carry = [src_units, tgt_units] if with_text else []   # arrays ride along only when text is asked for
    ex = df.select(key, k, *carry, F.posexplode(z).alias("i", "_p"))
    return ex.select(key, k, "i", F.col("_p.g").alias("src_prefix_len"), (F.col("i") + 1).alias("tgt_prefix_len"),
                     F.col("_p.u").alias("tgt_unit"),
                     *([F.array_join(F.slice(src_units, 1, F.col("_p.g")), src_sep).alias("src_prefix"),
                        F.array_join(F.slice(tgt_units, 1, F.col("i") + 1), tgt_sep).alias("tgt_prefix")]
                       if with_text else []))


def sample_k(key, seed: int, ks: Sequence[int] = (1, 3, 5, 7)) -> Column:
    """ST2: k drawn per example from ``ks`` by the first eight hex digits of md5(seed|key)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), _c(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*[F.lit(int(x)) for x in ks]), (F.pmod(h, F.lit(len(ks))) + 1).cast("int"))
