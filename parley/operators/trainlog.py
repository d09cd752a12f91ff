"""Training-loss logs: micro-batch numbering, step losses (W8), moving mean
(W7), finite check (AG20), head/tail means (AG21).

A run's series can be long, so nothing here is a window over a whole run:
numbering goes through ``global_index`` (range partitioned), and the moving
mean is a local frame over chunks of steps with a halo.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from parley.operators.common import global_index


def number_within(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """0-based position of each row inside its group by ``order``, distributed."""
    g = global_index(df, [group, *order], name="_gi")
    base = g.groupBy(group).agg(F.min("_gi").alias("_b"))  # one row per group
    return g.join(base, group).withColumn(name, F.col("_gi") - F.col("_b")).drop("_gi", "_b")


def with_loss(df: DataFrame, loss: str = "loss") -> DataFrame:
    """Micro-batches that have a loss; the others are skipped before numbering (NaN is a loss)."""
    return df.filter(F.col(loss).isNotNull())


def number_micro(df: DataFrame, run: str, order: Sequence[str], loss: str = "loss", name: str = "micro") -> DataFrame:
    """Micro-batch number inside each run, counting only batches with a loss."""
    return number_within(with_loss(df, loss), run, order, name)


def step_losses(log: DataFrame, grad_accum: int, run: str = "run", micro: str = "micro",
                loss: str = "loss") -> DataFrame:
    """step = floor(micro / grad_accum); mean of its micro losses; incomplete groups emit no step."""
    g = log.groupBy(run, F.floor(F.col(micro) / grad_accum).cast("long").alias("step")).agg(
        F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") == grad_accum).drop("n")


def moving_mean(steps: DataFrame, window: int = 50, run: str = "run", step: str = "step",
                loss: str = "loss", chunk: int = 10_000) -> DataFrame:
    """Mean of the last ``window`` step losses (steps 0..n-1 per run).

    Each run is cut into chunks of ``chunk`` steps (``window`` steps if that is more), and each chunk also gets the
    last ``window - 1`` steps of the chunk before it, so the frame is local: a
    window by (run, chunk) of bounded size, one shuffle, no self-join. Finite
    losses are summed as DECIMAL(28, 12), which does not depend on order. A NaN or infinite loss makes every mean
    whose frame holds it non-finite, and no later one.
    """
    chunk = max(chunk, window)
    at = F.floor(F.col(step) / chunk)
    late = (F.col(step) % chunk) > chunk - window   # the halo of the next chunk
    s = steps.select(run, step, loss, F.explode(F.when(late, F.array(at, at + 1)).otherwise(F.array(at))).alias("_chunk"))
    frame = W.partitionBy(run, "_chunk").orderBy(step).rowsBetween(-(window - 1), 0)
    odd = F.isnan(loss) | (F.abs(F.col(loss)) == float("inf"))
    exact = F.sum(F.when(~odd, F.col(loss).cast("decimal(28,12)"))).over(frame) / F.count(F.lit(1)).over(frame)
    out = s.withColumn("avg_loss", F.when(F.max(odd).over(frame), F.avg(loss).over(frame)).otherwise(exact.cast("double")))
    return out.filter(F.col("_chunk") == at).select(run, step, loss, "avg_loss")


def nonfinite_counts(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """AG20: rows and non-finite values (NaN or +-inf) per group."""
    bad = [F.count_if(F.isnan(c) | (F.abs(F.col(c)) == float("inf"))).alias(f"nonfinite_{c}") for c in cols]
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *bad)


def assert_finite(df: DataFrame, cols: Sequence[str]) -> None:
    """AG20: raise when any value is not finite."""
    r = nonfinite_counts(df, cols).first()
    bad = {c: r[f"nonfinite_{c}"] for c in cols if r[f"nonfinite_{c}"]}
    if bad:
        raise ValueError(f"non-finite values: {bad}")


def head_tail_mean(steps: DataFrame, k: int = 3, min_points: int = 4, run: str = "run", step: str = "step",
                   loss: str = "loss") -> DataFrame:
    """AG21: mean of the first k and last k step losses of each run with >= min_points steps."""
    n = steps.groupBy(run).agg(F.count(F.lit(1)).alias("n"), F.max(step).alias("_last"))
    j = steps.join(n, run)
    g = j.groupBy(run, "n").agg(F.avg(F.when(F.col(step) < k, F.col(loss))).alias("head_mean"),
                                F.avg(F.when(F.col(step) > F.col("_last") - k, F.col(loss))).alias("tail_mean"))
    return g.filter(F.col("n") >= min_points)
