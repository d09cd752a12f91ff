"""Checked queries for latency, training logs and weight vectors
(SQ12, AG17, ST1, ST2, ST6, ST7, W7, W8, AG20, AG21, SK8, SQ14, SQ15)."""
from __future__ import annotations

from pyspark.sql import functions as F

from parley.functions.text import words
from parley.functions.tokenize import chars
from parley.operators import latency as L
from parley.operators import metrics as M
from parley.operators import trainlog as TL
from parley.operators import vectors as VE
from parley.operators import vocab as V
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.plans.queries_metrics import sql_bleu, sql_match_stats, sql_tokzh
from parley.plans.queries_scores import KEEP_POS  # noqa: F401  (defines the vec_imp view)

SEED_K = 11
KS = (1, 3, 5, 7)
GRAD_ACCUM = 4
WINDOW = 50
KEEP_NEURONS = 100

O.add_view("lens", ["pairs_clean"], f"""
    SELECT doc_id * {X.LINE_BASE} + line_no AS ex_id, en, zh, CAST({O.word_count('en')} AS INTEGER) AS src_len,
           CAST(ceil(length(zh) / 2) AS INTEGER) AS tgt_len, CAST(ceil(length(zh) / 3) AS INTEGER) AS ref_len,
           CAST(1 + 2 * ((doc_id + line_no) % 4) AS INTEGER) AS k
    FROM pairs_clean""")
O.add_view("delays", ["lens"], """
    SELECT *, CASE WHEN tgt_len <= 0 THEN []::INTEGER[]
                   ELSE list_transform(range(0, tgt_len), lambda i: CAST(least(k + i, src_len) AS INTEGER)) END AS g
    FROM lens""")


def _lag_sql(ratio: str) -> str:
    tau = "coalesce(nullif(list_position(list_transform(g, lambda x: x >= src_len), true), 0), tgt_len)"
    return (f"CASE WHEN tgt_len = 0 OR src_len = 0 THEN 0.0 WHEN len(g) < {tau} THEN NULL ELSE "
            f"list_sum(list_transform(list_slice(g, 1, {tau}), lambda x, i: x - (i - 1) / ({ratio}))) / {tau} END")


AL_SQL = _lag_sql("tgt_len / src_len")
LAAL_SQL = _lag_sql("greatest(tgt_len, ref_len) / src_len")


def lens(spark, d):
    p = X.pairs_clean(spark, d)
    return p.select(X.ex_id(), "en", "zh", F.size(words("en")).alias("src_len"),
                    F.ceil(F.length("zh") / 2).cast("int").alias("tgt_len"),
                    F.ceil(F.length("zh") / 3).cast("int").alias("ref_len"),
                    (F.lit(1) + 2 * F.pmod(F.col("doc_id") + F.col("line_no"), F.lit(4))).cast("int").alias("k"))


def delays(spark, d):
    return lens(spark, d).withColumn("g", L.waitk_delays("src_len", "tgt_len", "k"))


# ------------------------------------------------------------------ SQ12 / AG17 / ST7
@register("sq12_waitk_delays", O.with_views(["delays"], "SELECT ex_id, k, array_to_string(g, ' ') AS g FROM delays"))
def sq12_waitk_delays(spark, d):
    return delays(spark, d).select("ex_id", "k", F.array_join("g", " ").alias("g"))


@register("ag17_average_lagging", O.with_views(["delays"], f"SELECT ex_id, k, round({AL_SQL}, 6) AS al FROM delays"))
def ag17_average_lagging(spark, d):
    return delays(spark, d).select("ex_id", "k", L.average_lagging("g", "src_len", "tgt_len").alias("al"))


@register("ag17_al_by_k", O.with_views(["delays"], f"""
    SELECT k, count(*) AS n, round(avg({AL_SQL}), 6) AS mean_al FROM delays GROUP BY k"""))
def ag17_al_by_k(spark, d):
    x = delays(spark, d).select("k", L.average_lagging("g", "src_len", "tgt_len").alias("al"))
    return x.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg("al").alias("mean_al"))


@register("st7_laal_by_k", O.with_views(["delays"], f"""
    SELECT k, round(avg({LAAL_SQL}), 6) AS mean_laal FROM delays GROUP BY k"""))
def st7_laal_by_k(spark, d):
    x = delays(spark, d).select("k", L.laal("g", "src_len", "tgt_len", "ref_len").alias("laal"))
    return x.groupBy("k").agg(F.avg("laal").alias("mean_laal"))


# ------------------------------------------------------------------ ST1 / ST2
@register("st1_waitk_pairs", O.with_views(["lens"], f"""
    SELECT ex_id, k, CAST(u.o - 1 AS INTEGER) AS i, u.v AS src_prefix_len, CAST(u.o AS INTEGER) AS tgt_prefix_len,
           tu[u.o] AS tgt_unit
    FROM (SELECT ex_id, k, tu, CASE WHEN len(tu) = 0 THEN []::INTEGER[]
                 ELSE list_transform(range(0, len(tu)), lambda i: CAST(least(k + i, len(su)) AS INTEGER)) END AS g
          FROM (SELECT ex_id, k, {O.word_list('en')} AS su,
                       CASE WHEN length(zh) = 0 THEN []::VARCHAR[] ELSE string_split(zh, '') END AS tu FROM lens)),
         unnest(g) WITH ORDINALITY AS u(v, o)"""))
def st1_waitk_pairs(spark, d):
    x = lens(spark, d).select("ex_id", "k", words("en").alias("su"), chars("zh").alias("tu"))
    return L.waitk_pairs(x, "ex_id", "su", "tu", "k")


@register("st2_sample_k", O.with_views(["lens"], f"""
    SELECT ex_id, CAST([{', '.join(map(str, KS))}][(CAST(('0x' || substr(md5('{SEED_K}|' || CAST(ex_id AS VARCHAR)), 1, 8))
                AS BIGINT) % {len(KS)}) + 1] AS INTEGER) AS k FROM lens"""))
def st2_sample_k(spark, d):
    return lens(spark, d).select("ex_id", L.sample_k("ex_id", SEED_K, KS).alias("k"))


# ------------------------------------------------------------------ ST6 (slow oracle)
O.add_view("st6_tok", ["lens"], f"""
    SELECT ex_id, k, {sql_tokzh('hyp')} AS ht, {sql_tokzh('zh')} AS rt FROM (
        SELECT ex_id, k, zh, array_to_string(list_filter(
            CASE WHEN length(zh) = 0 THEN []::VARCHAR[] ELSE string_split(zh, '') END, lambda x, i: i % (k + 1) <> 0), '')
            AS hyp FROM lens)""", materialized=True)


@register("st6_latency_quality", O.with_views(["delays", "st6_tok"], f"""
    SELECT a.k, round(a.mean_al, 6) AS mean_al, round(b.bleu, 6) AS bleu
    FROM (SELECT k, avg({AL_SQL}) AS mean_al FROM delays GROUP BY k) a
    JOIN ({sql_bleu(sql_match_stats('st6_tok', 'ex_id', ['k'], 'ht', 'rt', 4), ['k'])}) b USING (k)"""))
def st6_latency_quality(spark, d):
    x = delays(spark, d)
    al = x.groupBy("k").agg(F.avg(L.average_lagging("g", "src_len", "tgt_len")).alias("mean_al"))
    hyp = F.regexp_replace(F.col("zh"), F.format_string("(?s)(.{%d}).", F.col("k")), F.lit("$1"))  # drops every (k + 1)-th character
    r = x.select("ex_id", "k", M.spaced_zh(hyp).alias("ht"), M.spaced_zh(F.col("zh")).alias("rt"))
    return al.join(M.corpus_bleu(r, "ex_id", "ht", "rt", ["k"], sep=" "), "k")


# ------------------------------------------------------------------ W8 / W7 / AG20 / AG21
O.add_view("loss_log", [], """
    SELECT event_type AS run, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS BIGINT)
           AS micro, value AS loss FROM events WHERE value IS NOT NULL""")
O.add_view("steps", ["loss_log"], f"""
    SELECT run, step, loss FROM (
        SELECT run, CAST(floor(micro / {GRAD_ACCUM}) AS BIGINT) AS step, avg(loss) AS loss, count(*) AS n
        FROM loss_log GROUP BY 1, 2) WHERE n = {GRAD_ACCUM}""")


def loss_log(spark, d):
    e = X.table(spark, d, "events").select(F.col("event_type").alias("run"), "ts", "event_id",
                                             F.col("value").alias("loss"))
    return TL.number_micro(e, "run", ["ts", "event_id"]).select("run", "micro", "loss")


def steps(spark, d):
    return TL.step_losses(loss_log(spark, d), GRAD_ACCUM)


@register("w8_micro_numbering", O.with_views(["loss_log"], "SELECT run, micro, round(loss, 6) AS loss FROM loss_log"))
def w8_micro_numbering(spark, d):
    return loss_log(spark, d)


@register("w8_step_losses", O.with_views(["steps"], "SELECT run, step, round(loss, 6) AS loss FROM steps"))
def w8_step_losses(spark, d):
    return steps(spark, d)


@register("w7_moving_mean", O.with_views(["steps"], f"""
    SELECT run, step, round(loss, 6) AS loss,
           round(avg(CAST(loss AS DECIMAL(38, 12))) OVER (PARTITION BY run ORDER BY step
                                                          ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW), 6)
           AS avg_loss FROM steps"""))
def w7_moving_mean(spark, d):
    return TL.moving_mean(steps(spark, d), WINDOW)


@register("ag20_nonfinite", O.with_views(["loss_log"], """
    SELECT run, count(*) AS n, count_if(isnan(loss) OR isinf(loss)) AS nonfinite_loss FROM loss_log GROUP BY run"""))
def ag20_nonfinite(spark, d):
    log = X.table(spark, d, "events").select(F.col("event_type").alias("run"), F.col("value").alias("loss"))
    return TL.nonfinite_counts(TL.with_loss(log), ["loss"], ["run"])


@register("ag21_head_tail", O.with_views(["steps"], """
    SELECT run, n, round(head_mean, 6) AS head_mean, round(tail_mean, 6) AS tail_mean FROM (
        SELECT run, count(*) AS n, avg(loss) FILTER (WHERE step < 3) AS head_mean,
               avg(loss) FILTER (WHERE step > (SELECT max(step) FROM steps s2 WHERE s2.run = steps.run) - 3) AS tail_mean
        FROM steps GROUP BY run) WHERE n >= 4"""))
def ag21_head_tail(spark, d):
    return TL.head_tail_mean(steps(spark, d))


# ------------------------------------------------------------------ SK8 / SQ14 / SQ15
O.add_view("neuron_scores", ["next_vectors"], """
    SELECT a.vec_id AS row_id,
           sqrt(list_sum(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))
           + sqrt(list_sum(list_transform(b.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS score
    FROM next_vectors n JOIN embeddings a ON a.vec_id = n.vec_id JOIN embeddings b ON b.vec_id = n.next_id""")
O.add_view("kept_neurons", ["neuron_scores"], f"""
    SELECT row_id, score FROM (SELECT *, row_number() OVER (ORDER BY score DESC, row_id) AS rn FROM neuron_scores)
    WHERE rn <= {KEEP_NEURONS}""")


def weights(spark, d):
    e = X.table(spark, d, "embeddings")
    a = e.select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vec"))
    b = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("vec")).join(X.next_vectors(spark, d), "next_id")
    b = b.select(F.col("vec_id").alias("row_id"), "vec")
    return a, b


def kept_neurons(spark, d):
    a, b = weights(spark, d)
    return VE.select_neurons(a, b, KEEP_NEURONS)


@register("sk8_select_neurons", O.with_views(["kept_neurons"], "SELECT row_id, round(score, 6) AS score FROM kept_neurons"))
def sk8_select_neurons(spark, d):
    return kept_neurons(spark, d)


@register("sq14_embedding_rows", O.with_views(["kept_neurons"], """
    SELECT CAST(row_number() OVER (ORDER BY k.row_id) - 1 AS INTEGER) AS row_id, k.row_id AS old_id,
           round(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE))), 6) AS vec_sum
    FROM kept_neurons k JOIN embeddings e ON e.vec_id = k.row_id"""))
def sq14_embedding_rows(spark, d):
    a, _ = weights(spark, d)
    vm = V.vocab_map(kept_neurons(spark, d).select(F.col("row_id").alias("token_id")))
    r = VE.select_rows_by_map(a, vm)
    return r.select("row_id", "old_id", F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double")).alias("vec_sum"))


@register("sq15_slice_rows_columns", O.with_views(["kept_neurons", "vec_imp"], """
    SELECT e.vec_id AS row_id, round(list_sum(list_transform(idx.ix, lambda i: CAST(e.embedding[i + 1] AS DOUBLE))), 6)
           AS sliced_sum, CAST(len(idx.ix) AS INTEGER) AS width
    FROM embeddings e JOIN kept_neurons k ON k.row_id = e.vec_id,
         (SELECT list(pos ORDER BY pos) AS ix FROM (SELECT pos FROM (
             SELECT pos, row_number() OVER (ORDER BY importance DESC, pos) AS rn FROM vec_imp) WHERE rn <= 48)) idx"""))
def sq15_slice_rows_columns(spark, d):
    from parley.plans.queries_scores import KEEP_POS
    a, _ = weights(spark, d)
    rows = VE.slice_rows(a, kept_neurons(spark, d))
    top = VE.top_importance(VE.activation_importance(X.table(spark, d, "embeddings"), "embedding"), KEEP_POS)
    idx = sorted(r["pos"] for r in top.collect())   # KEEP_POS positions: bounded by the parameter
    s = VE.slice_columns(rows, idx)
    return s.select("row_id", F.aggregate("vec", F.lit(0.0), lambda t, x: t + x.cast("double")).alias("sliced_sum"),
                    F.size("vec").alias("width"))
