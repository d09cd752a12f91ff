"""Checked queries for file round trips and ordering helpers (IO1-IO4, IO7, IO8, SK5, SK6, U3)."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from parley.operators import corpus as C
from parley.operators import scores as SC
from parley.operators import profile as P
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.plans.queries_corpus import directed_dirty
from parley.plans.queries_scores import K
from parley.plans.queries_vocab import vmap_small
from parley.session import scratch_path
from parley.sources import files as IO

HEAD = 100


# ------------------------------------------------------------------ IO1 / IO2
@register("io1_io2_pairs_jsonl", O.with_views(["directed_dirty"], "SELECT src, tgt, direction FROM directed_dirty"))
def io1_io2_pairs_jsonl(spark, d):
    path = scratch_path(spark, "pairs-jsonl")
    IO.write_pairs(directed_dirty(spark, d), path)
    return IO.read_pairs(spark, path)


# ------------------------------------------------------------------ IO3 / IO4
@register("io3_io4_segments_text", O.with_views(["calib"], "SELECT lang, segment FROM calib"))
def io3_io4_segments_text(spark, d):
    path = scratch_path(spark, "segments")
    IO.write_segments(C.calib_segments(X.table(spark, d, "documents")), path, by="lang")
    return IO.read_segments(spark, path, by="lang")


# ------------------------------------------------------------------ IO7 / IO8
@register("io7_io8_vocab_map_json", O.with_views(["vmap_small"], "SELECT old_id, new_id FROM vmap_small"))
def io7_io8_vocab_map_json(spark, d):
    path = scratch_path(spark, "vmap")
    IO.write_vocab_map(vmap_small(spark, d), path + "/parquet", path + "/json")
    return IO.read_vocab_map(spark, path + "/json")


# ------------------------------------------------------------------ SK5 / SK6
@register("sk5_head_limit", O.with_views(["directed_dirty"], f"""
    SELECT ex_id, direction, src, tgt FROM directed_dirty ORDER BY ex_id, direction LIMIT {HEAD}"""))
def sk5_head_limit(spark, d):
    return C.head_rows(directed_dirty(spark, d), ["ex_id", "direction"], HEAD).select("ex_id", "direction", "src", "tgt")


@register("sk6_sorted_directions", O.with_views(["flags_dirty"], """
    SELECT direction, count(*) AS n FROM flags_dirty GROUP BY direction ORDER BY direction"""))
def sk6_sorted_directions(spark, d):
    prof = P.quality_profile(directed_dirty(spark, d)).filter(F.col("direction") != "__all__")
    return C.sorted_by(prof.select("direction", "n"))


# ------------------------------------------------------------------ U3
def embedding_scorer():
    """Stand-in teacher: the score vector of a row is its stored embedding (loaded once per task)."""
    def fn(b: pd.DataFrame) -> pd.Series:
        return pd.Series([np.asarray(v, dtype=float).tolist() for v in b["embedding"]])
    return fn


@register("u3_teacher_topk", f"""
    SELECT vec_id, array_to_string(list_transform(list_slice(list_sort(list_transform(embedding, lambda x, i:
           {{'v': CAST(x AS DOUBLE), 'ni': -(i - 1)}}), 'DESC'), 1, {K}), lambda s: -s.ni), ' ') AS top_ids
    FROM embeddings""")
def u3_teacher_topk(spark, d):
    e = X.table(spark, d, "embeddings")
    scored = SC.score_with(e, embedding_scorer, ["embedding"], "scores", keep=["vec_id"])
    t = SC.topk(scored, "scores", K)
    return t.select("vec_id", F.array_join("top_ids", " ").alias("top_ids"))
