"""Vector-table operators: importance by norms (SK8) or mean activation (EV6),
embedding row selection by a vocabulary map (SQ14), row and column slicing (SQ15).

Weight matrices are tables of (row_id, vec array<float>); a neuron / token is a row.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.common import broadcast_if_small


def l2_norm(v) -> Column:
    v = F.col(v) if isinstance(v, str) else v
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


# ---------------------------------------------------------------- SK8
def select_neurons(a: DataFrame, b: DataFrame, keep: int, id_col: str = "row_id", vec: str = "vec") -> DataFrame:
    """SK8: the ``keep`` rows with the largest ||a_row|| + ||b_row||, ids ascending.

    ``keep`` larger than the number of rows raises. Top-k by (score desc, id asc)
    through ``orderBy().limit`` (TakeOrdered: bounded by ``keep`` per task).
    """
    sa = a.select(id_col, l2_norm(vec).alias("_na"))
    sb = b.select(id_col, l2_norm(vec).alias("_nb"))
    scored = sa.join(sb, id_col).select(id_col, (F.col("_na") + F.col("_nb")).alias("score"))
    n = scored.count()
    if keep > n:
        raise ValueError(f"keep={keep} exceeds the {n} rows")
    top = scored.orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(keep)
    return top.orderBy(id_col)


# ---------------------------------------------------------------- EV6
def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a task: for each position the sum of absolute values and the number of values, over all vectors of the task."""
    sums, counts = np.zeros(0), np.zeros(0, np.int64)
    for b in batches:
        lists = b.column(0)
        flat = pc.list_flatten(lists).cast(pa.float64())
        row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        pos = np.arange(len(row)) - np.searchsorted(row, row)  # rows are in order: the place of a row's first value
        there = ~np.asarray(flat.is_null())
        pos, value = pos[there], np.abs(flat.drop_null().to_numpy(zero_copy_only=False))
        width = max(len(sums), int(pos.max()) + 1 if len(pos) else 0)
        sums, counts = (np.pad(x, (0, width - len(x))) for x in (sums, counts))
        sums += np.bincount(pos, value, width)
        counts += np.bincount(pos, minlength=width)
    if len(sums):
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64())), pa.array([counts], pa.list_(pa.int64()))], names=["sums", "counts"])


def activation_importance(acts: DataFrame, vec: str = "vec") -> DataFrame:
    """EV6: mean |activation| per vector position over a calibration table: (pos, importance).

    Each task adds its vectors up in one partial row of the vectors' width; only those rows are shuffled, by position. Null vectors and null
    values do not count; a position without a value has no row; vectors may differ in length; NaN makes its position NaN.
    """
    partial = acts.select(F.col(vec).cast("array<double>").alias(vec)).mapInArrow(_partial_sums, "sums array<double>, counts array<long>")
    ex = partial.select(F.posexplode(F.arrays_zip("sums", "counts")).alias("pos", "_p")).filter(F.col("_p.counts") > 0)
    return ex.groupBy("pos").agg((F.sum("_p.sums") / F.sum("_p.counts")).alias("importance"))


def top_importance(imp: DataFrame, k: int) -> DataFrame:
    """The ``k`` most important positions (importance desc, pos asc)."""
    return imp.orderBy(F.col("importance").desc(), F.col("pos").asc()).limit(k)


# ---------------------------------------------------------------- SQ14
def select_rows_by_map(emb: DataFrame, vmap: DataFrame, id_col: str = "row_id",
                       max_map_rows: int = 1_000_000) -> DataFrame:
    """SQ14: keep embedding rows whose id is a kept old id, renumbered to the new id."""
    m = broadcast_if_small(vmap.select("old_id", "new_id"), max_map_rows)
    return emb.join(m, emb[id_col] == m["old_id"]).select(
        F.col("new_id").alias(id_col), "old_id", *[c for c in emb.columns if c != id_col])


def restore_rows(pruned: DataFrame, original: DataFrame, vmap: DataFrame, id_col: str = "row_id") -> DataFrame:
    """SQ14 reversal: original rows of the kept ids, back under their old ids (join on new_id)."""
    back = pruned.select(F.col(id_col).alias("new_id")).join(vmap.select("old_id", "new_id"), "new_id")
    return original.join(back.select(F.col("old_id").alias(id_col)), id_col, "left_semi")


def extend_rows(pruned: DataFrame, original: DataFrame, vmap: DataFrame, add_ids: DataFrame,
                id_col: str = "row_id") -> DataFrame:
    """SQ14 extension: append original rows of ``add_ids`` not yet kept, numbered from n upward."""
    from parley.operators.common import global_index
    n = pruned.count()
    new = add_ids.select(F.col("token_id").alias("old_id")).distinct().join(
        vmap.select("old_id"), "old_id", "left_anti")
    new = global_index(new, ["old_id"], name="new_id", start=n)
    rows = original.join(new, original[id_col] == new["old_id"]).select(
        F.col("new_id").cast("int").alias(id_col), "old_id", *[c for c in original.columns if c != id_col])
    return pruned.unionByName(rows)


# ---------------------------------------------------------------- SQ15
def slice_rows(w: DataFrame, ids: DataFrame, id_col: str = "row_id") -> DataFrame:
    """SQ15 row subset (gate / up): semi join on the kept ids."""
    return w.join(ids.select(id_col), id_col, "left_semi")


def slice_columns(w: DataFrame, idx: list[int], vec: str = "vec") -> DataFrame:
    """SQ15 column subset (down): keep vector positions ``idx`` in that order."""
    arr = F.array(*[F.lit(int(i)) for i in idx])
    return w.withColumn(vec, F.transform(arr, lambda i: F.get(F.col(vec), i)))
