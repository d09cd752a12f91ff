"""Checked queries for score tables, losses and shards
(SK7, SQ8-SQ10, SQ13, J5, J6, J8, J9, W6, IO9-IO11, SK9, AG14-AG16, EV3, EV6)."""
from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import scores as SC
from parley.operators import shards as SH
from parley.operators import vectors as VE
from parley.operators import vocab as V
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.streaming.rowwise import through_stream
from parley.plans.queries_vocab import old_encoded, old_examples, old_texts
from parley.session import scratch_path
from parley.sources import shardstore as SS

K = 8                 # teacher top-k
KEEP_POS = 48         # score positions kept by activation importance (EV6)
T = 2.0               # distillation temperature
ALPHA, BETA = 0.5, 0.5
SHARD = 1000
BATCH = 16
SEED, EPOCH = 7, 1


def _ls_sql(arr: str, temp: float = 1.0) -> str:
    """DuckDB log-softmax of a list expression (arr must be a column name)."""
    x = f"list_transform({arr}, lambda x: CAST(x AS DOUBLE) / {temp})"
    return (f"list_transform({x}, lambda y: y - (list_max({x}) + "
            f"ln(list_sum(list_transform({x}, lambda z: exp(z - list_max({x})))))))")


O.add_view("vec_imp", [], """
    SELECT CAST(u.o - 1 AS INTEGER) AS pos, avg(abs(CAST(u.v AS DOUBLE))) AS importance
    FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(v, o) GROUP BY 1""")
O.add_view("vmap_vec", ["vec_imp"], f"""
    SELECT pos AS old_id, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS new_id FROM (
        SELECT pos, row_number() OVER (ORDER BY importance DESC, pos) AS rn FROM vec_imp) WHERE rn <= {KEEP_POS}""")
O.add_view("score_rows", ["next_vectors"], f"""
    SELECT s.vec_id, s.embedding AS logits, CASE WHEN s.vec_id % 10 = 0 THEN -100 ELSE s.label END AS label,
           t.embedding AS t_scores,
           list_slice(list_sort(list_transform(t.embedding, lambda x, i: {{'v': CAST(x AS DOUBLE), 'ni': -(i - 1)}}),
                                'DESC'), 1, {K}) AS tk
    FROM next_vectors n JOIN embeddings s ON s.vec_id = n.vec_id JOIN embeddings t ON t.vec_id = n.next_id""")
O.add_view("teacher_kept", ["score_rows", "vmap_vec"], """
    SELECT vec_id, list_transform(kept, lambda z: z.j) AS keep_pos, list_transform(kept, lambda z: z.n) AS new_ids,
           list_transform(kept, lambda z: z.v) AS raw
    FROM (SELECT r.vec_id, list_filter(list_transform(r.tk, lambda s, j: {'j': CAST(j - 1 AS INTEGER),
                     'n': map_extract_value(mm.m, CAST(-s.ni AS INTEGER)), 'v': s.v}), lambda z: z.n IS NOT NULL) AS kept
          FROM score_rows r, (SELECT map(list(old_id), list(new_id)) AS m FROM vmap_vec) mm)""")
O.add_view("teacher_norm", ["teacher_kept"], f"""
    SELECT vec_id, keep_pos, new_ids, CASE WHEN len(raw) = 0 THEN []::DOUBLE[] ELSE {_ls_sql('raw')} END AS logp
    FROM teacher_kept""")
O.add_view("teacher_pad", ["teacher_norm"], f"""
    SELECT vec_id, CAST(greatest(0, {K} - len(new_ids)) AS INTEGER) AS n_pad,
           list_slice(new_ids || list_transform(range(greatest(0, {K} - len(new_ids))), lambda x: 0), 1, {K}) AS t_ids,
           list_slice(logp || list_transform(range(greatest(0, {K} - len(new_ids))), lambda x: -30.0), 1, {K}) AS t_logp
    FROM teacher_norm""")
O.add_view("loss_rows", ["score_rows", "teacher_pad"], f"""
    SELECT r.vec_id, r.label, p.t_ids, p.t_logp, {_ls_sql('r.logits', T)} AS s_t, {_ls_sql('r.logits')} AS s_1
    FROM score_rows r JOIN teacher_pad p USING (vec_id)""")
O.add_view("loss_terms", ["loss_rows"], """
    SELECT vec_id, label, s_t, t_ids,
           list_sum(list_transform(list_zip(t_logp, list_transform(t_ids, lambda i: s_t[i + 1])),
                                   lambda z: exp(z[1]) * (z[1] - z[2]))) AS kd_row,
           CASE WHEN label <> -100 THEN -s_1[label + 1] END AS ce_row
    FROM loss_rows""")


def score_vectors(spark, d):
    e = X.table(spark, d, "embeddings")
    s = e.select("vec_id", F.col("embedding").alias("logits"),
                 F.when(F.col("vec_id") % 10 == 0, F.lit(-100)).otherwise(F.col("label")).alias("label"))
    t = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("t_scores"))
    return s.join(X.next_vectors(spark, d), "vec_id").join(t, "next_id").drop("next_id")


def score_rows(spark, d):
    return SC.topk(score_vectors(spark, d), "t_scores", K)


def vmap_vec(spark, d):
    top = VE.top_importance(VE.activation_importance(X.table(spark, d, "embeddings"), "embedding"), KEEP_POS)
    return V.vocab_map(top.select(F.col("pos").alias("token_id")))


def teacher(spark, d):
    return SC.remap_topk(score_rows(spark, d), ["vec_id"], "top_ids", "top_vals", vmap_vec(spark, d))


def loss_rows(spark, d):
    t = teacher(spark, d)
    ids, lp = SC.pad_topk("new_ids", "logp", K)
    t = t.select("vec_id", ids.alias("t_ids"), lp.alias("t_logp"))
    return score_rows(spark, d).select("vec_id", "logits", "label").join(t, "vec_id")


def s(c):
    return F.array_join(F.col(c), " ").alias(c)


# ------------------------------------------------------------------ EV6
@register("ev6_activation_importance", O.with_views(["vec_imp"], f"""
    SELECT pos, round(importance, 6) AS importance FROM (
        SELECT *, row_number() OVER (ORDER BY importance DESC, pos) AS rn FROM vec_imp) WHERE rn <= {KEEP_POS}"""))
def ev6_activation_importance(spark, d):
    return VE.top_importance(VE.activation_importance(X.table(spark, d, "embeddings"), "embedding"), KEEP_POS)


# ------------------------------------------------------------------ SK7
@register("sk7_topk", O.with_views(["score_rows"], """
    SELECT vec_id, array_to_string(list_transform(tk, lambda s: -s.ni), ' ') AS top_ids,
           round(list_sum(list_transform(tk, lambda s: s.v)), 6) AS top_sum FROM score_rows"""))
def sk7_topk(spark, d):
    r = score_rows(spark, d)
    return r.select("vec_id", s("top_ids"), F.aggregate("top_vals", F.lit(0.0), lambda a, x: a + x).alias("top_sum"))


# ------------------------------------------------------------------ SQ8
_sq8 = O.with_views(["teacher_kept"], """
    SELECT vec_id, array_to_string(keep_pos, ' ') AS keep_pos, array_to_string(new_ids, ' ') AS new_ids
    FROM teacher_kept""")


@register("sq8_remap_topk", _sq8)
def sq8_remap_topk(spark, d):
    return teacher(spark, d).select("vec_id", s("keep_pos"), s("new_ids"))


@register("sq8_topk_stream", _sq8)
def sq8_topk_stream(spark, d):
    """SK7 + SQ8 + SQ9 between a file source and a Parquet sink."""
    vm = vmap_vec(spark, d)

    def form(rows):
        return SC.remap_topk(SC.topk(rows, "t_scores", K), ["vec_id"], "top_ids", "top_vals", vm)
    out, _ = through_stream(score_vectors(spark, d).select("vec_id", "t_scores"), form, "sq8")
    return out.select("vec_id", s("keep_pos"), s("new_ids"))


# ------------------------------------------------------------------ SQ9
@register("sq9_renormalize", O.with_views(["teacher_norm"], """
    SELECT vec_id, array_to_string(new_ids, ' ') AS new_ids,
           round(list_sum(list_transform(logp, lambda x: exp(x))), 6) AS prob_sum,
           round(list_max(logp), 6) AS max_logp FROM teacher_norm"""))
def sq9_renormalize(spark, d):
    t = teacher(spark, d)
    return t.select("vec_id", s("new_ids"),
                    F.aggregate("logp", F.lit(0.0), lambda a, x: a + F.exp(x)).alias("prob_sum"),
                    F.array_max("logp").alias("max_logp"))


# ------------------------------------------------------------------ SQ10
@register("sq10_pad_topk", O.with_views(["teacher_pad"], """
    SELECT vec_id, array_to_string(t_ids, ' ') AS t_ids, n_pad, round(list_sum(t_logp), 6) AS logp_sum
    FROM teacher_pad"""))
def sq10_pad_topk(spark, d):
    t = teacher(spark, d)
    ids, lp = SC.pad_topk("new_ids", "logp", K)
    p = t.select("vec_id", ids.alias("t_ids"), lp.alias("t_logp"),
                 F.greatest(F.lit(0), F.lit(K) - F.size("new_ids")).alias("n_pad"))
    return p.select("vec_id", s("t_ids"), "n_pad", F.aggregate("t_logp", F.lit(0.0), lambda a, x: a + x).alias("logp_sum"))


# ------------------------------------------------------------------ J8
@register("j8_gather", O.with_views(["loss_terms"], """
    SELECT vec_id, round(list_sum(list_transform(t_ids, lambda i: s_t[i + 1])), 6) AS gathered_sum FROM loss_terms"""))
def j8_gather(spark, d):
    r = SC.with_student_logp(loss_rows(spark, d), "logits", T)
    g = r.select("vec_id", SC.gather("_s_t", "t_ids").alias("_g"))
    return g.select("vec_id", F.aggregate("_g", F.lit(0.0), lambda a, x: a + x).alias("gathered_sum"))


# ------------------------------------------------------------------ AG14 / AG15 / AG16
@register("ag14_kd_loss", O.with_views(["loss_terms"], f"""
    SELECT round(avg(kd_row) * {T * T}, 6) AS kd FROM loss_terms"""))
def ag14_kd_loss(spark, d):
    return SC.kd_forward_kl(loss_rows(spark, d), "logits", "t_ids", "t_logp", T)


@register("ag15_ce_loss", O.with_views(["loss_terms"], "SELECT round(avg(ce_row), 6) AS ce FROM loss_terms"))
def ag15_ce_loss(spark, d):
    return SC.ce_loss(loss_rows(spark, d), "logits", "label")


@register("ag16_combined_loss", O.with_views(["loss_terms"], f"""
    SELECT round({ALPHA} * ce + {BETA} * kd, 6) AS total, round(ce, 6) AS ce, round(kd, 6) AS kd
    FROM (SELECT avg(ce_row) AS ce, avg(kd_row) * {T * T} AS kd FROM loss_terms)"""))
def ag16_combined_loss(spark, d):
    return SC.combined_loss(loss_rows(spark, d), "logits", "label", "t_ids", "t_logp", ALPHA, BETA, T)


@register("ag16_loss_by_label", O.with_views(["loss_terms"], f"""
    SELECT label, round({ALPHA} * ce + {BETA} * kd, 6) AS total, round(ce, 6) AS ce, round(kd, 6) AS kd
    FROM (SELECT label, avg(ce_row) AS ce, avg(kd_row) * {T * T} AS kd FROM loss_terms GROUP BY label)"""))
def ag16_loss_by_label(spark, d):
    return SC.combined_loss(loss_rows(spark, d), "logits", "label", "t_ids", "t_logp", ALPHA, BETA, T,
                            group_by=["label"])


# ------------------------------------------------------------------ EV3
@register("ev3_union_reverse_kl", O.with_views(["score_rows"], f"""
    SELECT vec_id, round(list_sum(list_transform(list_zip(ls, lt), lambda z: exp(z[1]) * (z[1] - z[2]))), 6) AS rkl
    FROM (SELECT vec_id, {_ls_sql('gs')} AS ls, {_ls_sql('gt')} AS lt FROM (
        SELECT vec_id, list_transform(u, lambda i: logits[i + 1]) AS gs, list_transform(u, lambda i: t_scores[i + 1]) AS gt
        FROM (SELECT vec_id, logits, t_scores,
                     list_distinct(list_concat(
                         list_transform(list_slice(list_sort(list_transform(logits, lambda x, i:
                             {{'v': CAST(x AS DOUBLE), 'ni': -(i - 1)}}), 'DESC'), 1, {K}), lambda q: -q.ni),
                         list_transform(tk, lambda q: -q.ni))) AS u
              FROM score_rows)))"""))
def ev3_union_reverse_kl(spark, d):
    r = SC.topk(score_rows(spark, d), "logits", K, ids_col="s_ids", vals_col="s_vals")
    return SC.union_reverse_kl(r, "logits", "s_ids", "t_scores", "top_ids").select("vec_id", "rkl")


# ------------------------------------------------------------------ J6 (long form)
@register("j6_shift_previous", O.with_views(["score_rows"], """
    SELECT vec_id, ex, pos, pred_id FROM (
        SELECT vec_id, vec_id // 8 AS ex, CAST(vec_id % 8 AS INTEGER) AS pos,
               lag(CAST(-tk[1].ni AS INTEGER)) OVER (PARTITION BY vec_id // 8 ORDER BY vec_id % 8) AS pred_id
        FROM score_rows) WHERE pos >= 1"""))
def j6_shift_previous(spark, d):
    r = score_rows(spark, d).select("vec_id", (F.col("vec_id") / 8).cast("bigint").alias("ex"),
                                    (F.col("vec_id") % 8).cast("int").alias("pos"),
                                    F.get("top_ids", 0).alias("top1"))
    out = SC.shift_previous(r, "ex", "pos", ["top1"])
    return out.filter(F.col("pos") >= 1).select("vec_id", "ex", "pos", F.col("prev_top1").alias("pred_id"))


# ------------------------------------------------------------------ J5 + J6 (array form) + SQ11
@register("j5_aligned_teacher", O.with_views(["old_examples"], """
    SELECT row_id, CAST(len(tp) AS INTEGER) AS n_target, array_to_string(list_transform(tp, lambda p: input_ids[p]), ' ') AS prev_ids
    FROM (SELECT row_id, input_ids, list_filter(range(1, len(labels)), lambda p: labels[p + 1] <> -100) AS tp
          FROM old_examples)"""))
def j5_aligned_teacher(spark, d):
    from parley.operators.export import aligned_count
    from parley.operators.sequences import target_positions
    e = old_examples(spark, d).withColumn("tp", target_positions("labels"))
    e = e.withColumn("t_rows", F.transform("tp", lambda p: F.array(F.get(F.col("input_ids"), p - 1))))
    return e.select("row_id", aligned_count("tp", "t_rows").alias("n_target"),
                    F.array_join(F.transform("t_rows", lambda r: r[0]), " ").alias("prev_ids"))


# ------------------------------------------------------------------ IO9 / W6 / IO10 / IO11 / SK9 / SQ13
O.add_view("sharded", ["old_examples"], f"""
    SELECT row_id, input_ids, CAST(rn - 1 AS BIGINT) AS global_idx, CAST((rn - 1) // {SHARD} AS INTEGER) AS shard_id,
           CAST((rn - 1) % {SHARD} AS INTEGER) AS local_idx
    FROM (SELECT *, row_number() OVER (ORDER BY row_id) AS rn FROM old_examples)""")


def numbered_examples(texts):
    return old_encoded(texts, ("row_id", "global_idx", "local_idx", "shard_id"))


def write_example_shards(spark, d):
    """Texts are numbered and dealt into shards, and encoded there: token ids are several times as wide."""
    path = scratch_path(spark, "shards")
    man = SH.write_shards(old_texts(spark, d), path, ["row_id"], SHARD, numbered_examples)
    return path, man


@register("io9_shard_manifest", O.with_views(["sharded"], """
    SELECT shard_id, count(*) AS n, CAST(min(global_idx) AS BIGINT) AS start, CAST(max(global_idx) + 1 AS BIGINT) AS "end"
    FROM sharded GROUP BY shard_id"""))
def io9_shard_manifest(spark, d):
    _, man = write_example_shards(spark, d)
    return man.select("shard_id", "n", "start", "end")


@register("io9_shard_commit", O.with_views(["sharded"], """
    SELECT shard_id, count(*) AS n, CAST(min(global_idx) AS BIGINT) AS start, CAST(max(global_idx) + 1 AS BIGINT) AS "end",
           CAST(sum(row_id) AS BIGINT) AS ids, sum(len(input_ids)) AS tokens FROM sharded GROUP BY shard_id"""))
def io9_shard_commit(spark, d):
    """Shards and manifest committed together by the registered data source, both read back."""
    path = scratch_path(spark, "committed")
    man = SS.write_committed(old_texts(spark, d), path, ["row_id"], SHARD, numbered_examples)
    rows = spark.read.format(SS.FORMAT).load(path).groupBy("shard_id").agg(
        F.sum("row_id").cast("bigint").alias("ids"), F.sum(F.size("input_ids")).cast("bigint").alias("tokens"))
    return man.join(rows, "shard_id").select("shard_id", "n", "start", "end", "ids", "tokens")


@register("io10_shard_reader", O.with_views(["sharded"], """
    SELECT shard_id, count(*) AS rows, min(local_idx) AS min_local, max(local_idx) AS max_local,
           CAST(min(row_id) AS BIGINT) AS first_row FROM sharded GROUP BY shard_id"""))
def io10_shard_reader(spark, d):
    path, _ = write_example_shards(spark, d)
    t = SH.ShardReader(spark, path).table()
    return t.groupBy("shard_id").agg(F.count(F.lit(1)).alias("rows"), F.min("local_idx").alias("min_local"),
                                     F.max("local_idx").alias("max_local"), F.min("row_id").alias("first_row"))


@register("io11_locate", O.with_views(["sharded"], f"""
    SELECT idx, CASE WHEN idx < (SELECT count(*) FROM sharded) THEN CAST(idx // {SHARD} AS INTEGER) END AS shard_id,
           CASE WHEN idx < (SELECT count(*) FROM sharded) THEN CAST(idx % {SHARD} AS INTEGER) END AS local_idx
    FROM (SELECT vec_id * 37 AS idx FROM embeddings)"""))
def io11_locate(spark, d):
    _, man = write_example_shards(spark, d)
    idx = X.table(spark, d, "embeddings").select((F.col("vec_id") * 37).alias("idx"))
    return SH.locate(man, idx, "idx")


O.add_view("visit", ["sharded"], f"""
    SELECT row_id, shard_id, input_ids,
           dense_rank() OVER (ORDER BY md5('{SEED}|{EPOCH}|' || CAST(shard_id AS VARCHAR))) AS shard_rank,
           row_number() OVER (PARTITION BY shard_id ORDER BY md5('{SEED}|{EPOCH}|' || CAST(global_idx AS VARCHAR)))
               AS row_rank
    FROM sharded""")


def visit(spark, d):
    path, _ = write_example_shards(spark, d)
    return SH.shuffled_order(SH.ShardReader(spark, path).table(), SEED, EPOCH)


@register("sk9_shard_shuffle", O.with_views(["visit"], """
    SELECT row_id, shard_id, CAST(shard_rank AS INTEGER) AS shard_rank, CAST(row_rank AS INTEGER) AS row_rank FROM visit"""))
def sk9_shard_shuffle(spark, d):
    return visit(spark, d).select("row_id", "shard_id", "shard_rank", "row_rank")


@register("sq13_batches", O.with_views(["visit"], f"""
    SELECT row_id, shard_id, CAST((row_rank - 1) // {BATCH} AS INTEGER) AS batch_id,
           CAST(max(len(input_ids)) OVER (PARTITION BY shard_id, (row_rank - 1) // {BATCH}) AS INTEGER) AS padded_len,
           CAST(len(input_ids) AS INTEGER) AS mask_sum FROM visit"""))
def sq13_batches(spark, d):
    b = SH.batches(visit(spark, d), BATCH)
    return b.select("row_id", "shard_id", "batch_id", F.size("padded_ids").alias("padded_len"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


# ------------------------------------------------------------------ teacher export, written to shards and read back
T_WIDTH, T_K = 128, 8           # scores over old ids below T_WIDTH, the best T_K of them


def hash_scorer(contexts):
    """A deterministic stand-in for a model: the scores over old ids after each context id."""
    import numpy as np
    return ((contexts[:, None] * 31 + np.arange(T_WIDTH)[None, :] * 17) % 97) / 10.0


@register("io9_teacher_records", O.with_views(["old_examples", "vmap_small"], f"""
    , pos AS (SELECT row_id, p, input_ids[p] AS x FROM (
          SELECT row_id, input_ids, unnest(list_filter(range(1, len(labels)), lambda p: labels[p + 1] <> -100)) AS p FROM old_examples)),
    tk AS (SELECT x, j, s, row_number() OVER (PARTITION BY x ORDER BY s DESC, j) AS rn FROM (
          SELECT x, j, ((x * 31 + j * 17) % 97) / 10.0 AS s FROM (SELECT DISTINCT x FROM pos), range({T_WIDTH}) t(j)) QUALIFY rn <= {T_K}),
    top AS (SELECT x, list(m.new_id ORDER BY rn) AS ids, -ln(sum(exp(s - mx))) AS first_logp FROM (
          SELECT x, rn, s, m.new_id, max(s) OVER (PARTITION BY x) AS mx FROM tk JOIN vmap_small m ON m.old_id = tk.j) m GROUP BY x),
    mm AS (SELECT map(list(old_id), list(new_id)) AS m FROM vmap_small),
    eos AS (SELECT coalesce((SELECT new_id FROM vmap_small WHERE old_id = 1), 0) AS oov)
    SELECT e.row_id, n_target,
      array_to_string(list_transform(e.input_ids, lambda v: coalesce(map_extract_value(mm.m, v), eos.oov)), ' ') AS input_ids,
      array_to_string(list_transform(e.labels, lambda v: CASE WHEN v = -100 THEN -100 ELSE coalesce(map_extract_value(mm.m, v), eos.oov) END), ' ') AS labels,
      t_ids, round(logp, 6) AS first_logp_sum
    FROM old_examples e, mm, eos, (
        SELECT row_id, CAST(count(*) AS INTEGER) AS n_target, sum(coalesce(first_logp, -30.0)) AS logp,
               string_agg(array_to_string(list_resize(coalesce(ids, []), {T_K}, 0), ' '), '|' ORDER BY p) AS t_ids
        FROM pos LEFT JOIN top USING (x) GROUP BY row_id) t
    WHERE t.row_id = e.row_id"""))
def io9_teacher_records(spark, d):
    from parley.operators import export as EX
    from parley.operators.sequences import choose_oov_id, target_positions
    from parley.plans.queries_vocab import EOS_OLD, PAD_OLD, UNK_OLD, vmap_small
    vm = vmap_small(spark, d).checkpoint()   # vocabulary-sized, read three times
    _, oov = choose_oov_id(vm, EOS_OLD, UNK_OLD, PAD_OLD)
    path = scratch_path(spark, "teacher")
    SH.write_shards(EX.with_targets(old_examples(spark, d)), path, ["row_id"], SHARD, lambda s: EX.teacher_records(
        s, vm, hash_scorer, T_K, oov, key="row_id", keep=("global_idx", "local_idx", "shard_id"), packed=True))
    r = SH.ShardReader(spark, path).table()
    return r.select("row_id", EX.aligned_count(target_positions("labels"), "t_ids", T_K).alias("n_target"),
                    EX.ids_text("input_ids").alias("input_ids"), EX.ids_text("labels").alias("labels"), EX.packed_text("t_ids", T_K).alias("t_ids"),
                    EX.packed_first_sum("t_logp", T_K).alias("first_logp_sum"))
