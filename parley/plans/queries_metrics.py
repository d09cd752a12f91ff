"""Checked queries for evaluation metrics
(J7, U4-U6, AG9-AG13, IO12, IO13, EV1, EV2, EV4, EV5)."""
from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from parley.operators import corpus as C
from parley.operators import metrics as M
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.plans.queries_vocab import directed_clean
from parley.session import scratch_path
from parley.sources import files as IO

DROP_EVERY = 5
CHECKPOINTS = [(3000, 3), (6000, 4), (9000, 6)]          # (checkpoint, drop every m-th unit)
SYSTEMS = [("base", 2), ("student", 5), ("teacher", 9)]
BASELINE = "base"

# ---------------------------------------------------------------- SQL twins of the tokenizers
_R_13A = [(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
          (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")]
_ZH_RE2 = (r"([\x{2e80}-\x{2fff}\x{3000}-\x{303f}\x{3100}-\x{312f}\x{31a0}-\x{31ef}\x{3200}-\x{4dbf}"
           r"\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{fe10}-\x{fe1f}\x{fe30}-\x{fe4f}\x{ff00}-\x{ffef}])")


def _sql_rules(t: str) -> str:
    for pat, rep in _R_13A:
        t = f"regexp_replace({t}, '{pat}', '{rep}', 'g')"
    return f"list_filter(string_split(trim(regexp_replace({t}, '{O.WS}+', ' ', 'g')), ' '), lambda w: w <> '')"


def sql_tok13a(x: str) -> str:
    t = f"replace(replace(replace(coalesce({x}, ''), '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = f"replace({t}, '{a}', '{b}')"
    return _sql_rules(f"(' ' || {t} || ' ')")


def sql_tokzh(x: str) -> str:
    return _sql_rules(f"regexp_replace(trim(coalesce({x}, '')), '{_ZH_RE2}', ' \\1 ', 'g')")


def sql_bleu_tokens(x: str, direction: str = "direction") -> str:
    return f"(CASE WHEN ends_with({direction}, '2zh') THEN {sql_tokzh(x)} ELSE {sql_tok13a(x)} END)"


def sql_chars(x: str) -> str:
    return f"(CASE WHEN length({x}) = 0 THEN []::VARCHAR[] ELSE string_split({x}, '') END)"


def sql_chrf_chars(x: str) -> str:
    return sql_chars(f"regexp_replace(coalesce({x}, ''), '{O.WS}+', '', 'g')")


def _grams(x: str) -> str:
    return (f"(CASE WHEN len({x}) >= n THEN list_transform(range(1, len({x}) - n + 2), "
            f"lambda i: array_to_string(list_slice({x}, i, i + n - 1), chr(1))) ELSE []::VARCHAR[] END)")


def sql_match_stats(rel: str, key: str, groups: list[str], h: str, r: str, orders: int) -> str:
    """Per (groups, n): clipped matches and n-gram counts. Tokens are unnested with their
    position and n-grams built with ``lead`` windows per (row, side)."""
    g = ", ".join(groups)
    gp = (g + ", ") if groups else ""
    leads = ", ".join(
        ("tok AS g1" if n == 1 else
         "(" + " || chr(1) || ".join(["tok"] + [f"lead(tok, {k}) OVER w" for k in range(1, n)]) + f") AS g{n}")
        for n in range(1, orders + 1))
    unp = " UNION ALL ".join(f"SELECT {key}, {gp}side, {n} AS n, g{n} AS g FROM grams WHERE g{n} IS NOT NULL"
                             for n in range(1, orders + 1))
    return f"""
      (WITH toks AS (
           SELECT {key}, {gp}'h' AS side, u.v AS tok, u.o AS pos FROM {rel}, unnest({h}) WITH ORDINALITY AS u(v, o)
           UNION ALL
           SELECT {key}, {gp}'r' AS side, u.v AS tok, u.o AS pos FROM {rel}, unnest({r}) WITH ORDINALITY AS u(v, o)),
       grams AS (SELECT {key}, {gp}side, {leads} FROM toks WINDOW w AS (PARTITION BY {key}, {gp}side ORDER BY pos)),
       counted AS (SELECT {key}, {gp}n, g, count_if(side = 'h') AS h, count_if(side = 'r') AS r FROM ({unp})
                   GROUP BY {key}, {gp}n, g)
       SELECT {gp}n, CAST(sum(least(h, r)) AS BIGINT) AS matches, CAST(sum(h) AS BIGINT) AS hyp_grams,
              CAST(sum(r) AS BIGINT) AS ref_grams FROM counted GROUP BY {gp}n)"""


def _pivot(stats: str, groups: list[str], orders: int) -> str:
    g = ", ".join(groups)
    cols = []
    for n in range(1, orders + 1):
        cols += [f"coalesce(sum(CASE WHEN n = {n} THEN matches END), 0) AS m{n}",
                 f"coalesce(sum(CASE WHEN n = {n} THEN hyp_grams END), 0) AS h{n}",
                 f"coalesce(sum(CASE WHEN n = {n} THEN ref_grams END), 0) AS r{n}"]
    gb = f"GROUP BY {g}" if groups else ""
    sel = (g + ", ") if groups else ""
    return f"SELECT {sel}{', '.join(cols)} FROM ({stats}) {gb}"


def sql_bleu(stats: str, groups: list[str]) -> str:
    g = (", ".join(groups) + ", ") if groups else ""
    z = [" + ".join(f"CAST(m{i} = 0 AS INTEGER)" for i in range(1, n + 1)) for n in range(1, 5)]
    logs = [f"CASE WHEN m{n} > 0 THEN ln(m{n} / h{n}) ELSE -ln(pow(2.0, {z[n - 1]}) * greatest(h{n}, 1)) END"
            for n in range(1, 5)]
    return f"""
        SELECT {g}CASE WHEN h1 = 0 OR h2 = 0 OR h3 = 0 OR h4 = 0 OR m1 + m2 + m3 + m4 = 0 THEN 0.0
                       ELSE 100.0 * (CASE WHEN h1 >= r1 THEN 1.0 ELSE exp(1.0 - r1 / h1) END)
                            * exp(({' + '.join(f'({x})' for x in logs)}) / 4.0) END AS bleu
        FROM ({_pivot(stats, groups, 4)})"""


def sql_chrf(stats: str, groups: list[str]) -> str:
    g = (", ".join(groups) + ", ") if groups else ""
    p = " + ".join(f"(CASE WHEN h{n} > 0 THEN m{n} / h{n} ELSE 1e-16 END)" for n in range(1, 7))
    r = " + ".join(f"(CASE WHEN r{n} > 0 THEN m{n} / r{n} ELSE 1e-16 END)" for n in range(1, 7))
    eff = " + ".join(f"CAST(h{n} > 0 AND r{n} > 0 AS INTEGER)" for n in range(1, 7))
    return f"""
        SELECT {g}CASE WHEN p + r > 0 THEN 100.0 * 5.0 * p * r / (4.0 * p + r) ELSE 0.0 END AS chrf FROM (
            SELECT *, CASE WHEN eff > 0 THEN ({p}) / eff ELSE 0.0 END AS p,
                      CASE WHEN eff > 0 THEN ({r}) / eff ELSE 0.0 END AS r
            FROM (SELECT *, {eff} AS eff FROM ({_pivot(stats, groups, 6)})))"""


def _units_sql(x: str) -> str:
    return f"(CASE WHEN ends_with(direction, '2zh') THEN {sql_chars(x)} ELSE string_split({x}, ' ') END)"


O.add_view("hyp_ref", ["directed_clean"], f"""
    SELECT ex_id, direction, src, tgt AS ref,
           CASE WHEN ends_with(direction, '2zh') THEN array_to_string(kept, '') ELSE array_to_string(kept, ' ') END AS hyp,
           CAST(len(kept) AS INTEGER) AS gen_tok
    FROM (SELECT *, list_filter({_units_sql('tgt')}, lambda x, i: i % {DROP_EVERY} <> 0) AS kept FROM directed_clean)""")
O.add_view("hr_tok", ["hyp_ref"], f"""
    SELECT ex_id, direction, {sql_bleu_tokens('hyp')} AS ht, {sql_bleu_tokens('ref')} AS rt,
           {sql_chrf_chars('hyp')} AS hc, {sql_chrf_chars('ref')} AS rc FROM hyp_ref""", materialized=True)


def _variants_sql(name: str, variants) -> str:
    vals = ", ".join(f"('{a}', {m})" if isinstance(a, str) else f"({a}, {m})" for a, m in variants)
    return f"""
    SELECT ex_id, direction, {name}, {sql_bleu_tokens('hyp')} AS ht, {sql_bleu_tokens('tgt')} AS rt,
           {sql_chrf_chars('hyp')} AS hc, {sql_chrf_chars('tgt')} AS rc
    FROM (SELECT *, CASE WHEN ends_with(direction, '2zh') THEN array_to_string(kept, '')
                         ELSE array_to_string(kept, ' ') END AS hyp
          FROM (SELECT d.*, v.{name}, list_filter({_units_sql('d.tgt')}, lambda x, i: i % v.m <> 0) AS kept
                FROM directed_clean d, (VALUES {vals}) v({name}, m)))"""


O.add_view("ck_tok", ["directed_clean"], _variants_sql("checkpoint", CHECKPOINTS), materialized=True)
O.add_view("sys_tok", ["directed_clean"], _variants_sql("system", SYSTEMS), materialized=True)


# ---------------------------------------------------------------- Spark fixtures
def hyp_ref(spark, d):
    """M12 records: ref = target line, hyp = the same line with every fifth unit removed.

    Character targets (2zh) drop every fifth code point with one linear regex pass;
    word targets filter the space-split words.
    """
    dc = directed_clean(spark, d)
    is_zh = F.col("direction").endswith("2zh")
    words_kept = F.filter(F.split("tgt", " "), lambda x, i: (i + 1) % DROP_EVERY != 0)
    n = F.length("tgt")
    hyp = F.when(is_zh, F.regexp_replace("tgt", "(?s)(.{%d})." % (DROP_EVERY - 1), "$1")) \
           .otherwise(F.array_join(words_kept, " "))
    gen_tok = F.when(is_zh, n - F.floor(n / DROP_EVERY)).otherwise(F.size(words_kept)).cast("int")
    return dc.select("ex_id", "direction", "src", hyp.alias("hyp"), F.col("tgt").alias("ref"), gen_tok.alias("gen_tok"))


def variants(spark, d, name, values):
    dc = directed_clean(spark, d)
    # characters (2zh) drop every m-th code point by one regex pass, words are filtered
    def hyp(m):
        words_kept = F.filter(F.split("tgt", " "), lambda u, i: (i + 1) % m != 0)
        return F.when(F.col("direction").endswith("2zh"), F.regexp_replace("tgt", "(?s)(.{%d})." % (m - 1), "$1")) \
                .otherwise(F.array_join(words_kept, " "))

    v = F.inline(F.array(*[F.struct(F.lit(a).alias(name), hyp(m).alias("hyp")) for a, m in values]))
    return dc.select("ex_id", "direction", "src", F.col("tgt").alias("ref"), v).select("ex_id", "direction", name, "src", "hyp", "ref")


def scores_by(records, group):
    return M.corpus_scores(records, group)


# ------------------------------------------------------------------ U6
@register("u6_bleu_tokens", O.with_views(["hyp_ref"], f"""
    SELECT ex_id, direction, array_to_string({sql_bleu_tokens('hyp')}, ' ') AS hyp_tokens,
           array_to_string({sql_bleu_tokens('ref')}, ' ') AS ref_tokens FROM hyp_ref"""))
def u6_bleu_tokens(spark, d):
    r = hyp_ref(spark, d)
    return r.select("ex_id", "direction",
                    F.array_join(M.bleu_tokens(F.col("hyp"), F.col("direction")), " ").alias("hyp_tokens"),
                    F.array_join(M.bleu_tokens(F.col("ref"), F.col("direction")), " ").alias("ref_tokens"))


# ------------------------------------------------------------------ AG9
@register("ag9_corpus_bleu", O.with_views(["hr_tok"], f"""
    SELECT direction, round(bleu, 6) AS bleu FROM ({sql_bleu(sql_match_stats('hr_tok', 'ex_id', ['direction'],
                                                                              'ht', 'rt', 4), ['direction'])})"""))
def ag9_corpus_bleu(spark, d):
    r = hyp_ref(spark, d)
    r = r.select("ex_id", "direction", M.bleu_spaced(F.col("hyp"), F.col("direction")).alias("ht"),
                 M.bleu_spaced(F.col("ref"), F.col("direction")).alias("rt"))
    return M.corpus_bleu(r, "ex_id", "ht", "rt", ["direction"], sep=" ")


@register("ag9_bleu_whitespace_pooled", O.with_views(["hyp_ref"], f"""
    SELECT round(bleu, 6) AS bleu FROM ({sql_bleu(sql_match_stats(
        f"(SELECT ex_id, direction, {O.word_list('hyp')} AS wh, {O.word_list('ref')} AS wr FROM hyp_ref)",
        'ex_id, direction', [], 'wh', 'wr', 4), [])})"""))
def ag9_bleu_whitespace_pooled(spark, d):
    from parley.functions.text import norm_ws
    r = hyp_ref(spark, d).select(F.concat_ws(":", "ex_id", "direction").alias("k"),
                                 norm_ws("hyp").alias("wh"), norm_ws("ref").alias("wr"))
    return M.corpus_bleu(r, "k", "wh", "wr", sep=" ")


# ------------------------------------------------------------------ AG10
@register("ag10_corpus_chrf", O.with_views(["hr_tok"], f"""
    SELECT direction, round(chrf, 6) AS chrf FROM ({sql_chrf(sql_match_stats('hr_tok', 'ex_id', ['direction'],
                                                                               'hc', 'rc', 6), ['direction'])})
    UNION ALL
    SELECT NULL AS direction, round(chrf, 6) AS chrf FROM ({sql_chrf(sql_match_stats(
        '(SELECT ex_id || direction AS k, hc, rc FROM hr_tok)', 'k', [], 'hc', 'rc', 6), [])})"""))
def ag10_corpus_chrf(spark, d):
    return M.corpus_chrf(hyp_ref(spark, d), "ex_id", "hyp", "ref", ["direction"], with_total=True)


# ------------------------------------------------------------------ AG11 / AG12 / IO12 / IO13
AG11_SQL = O.with_views(["hyp_ref", "hr_tok"], f"""
    SELECT b.direction, s.samples, round(s.avg_hyp_chars, 6) AS avg_hyp_chars, round(b.bleu, 6) AS bleu,
           round(c.chrf, 6) AS chrf
    FROM ({sql_bleu(sql_match_stats('hr_tok', 'ex_id', ['direction'], 'ht', 'rt', 4), ['direction'])}) b
    JOIN ({sql_chrf(sql_match_stats('hr_tok', 'ex_id', ['direction'], 'hc', 'rc', 6), ['direction'])}) c USING (direction)
    JOIN (SELECT direction, count(*) AS samples, avg(length(hyp)) AS avg_hyp_chars FROM hyp_ref GROUP BY direction) s
      USING (direction)
    UNION ALL
    SELECT '__all__', NULL, NULL, NULL, round(chrf, 6) FROM ({sql_chrf(sql_match_stats(
        '(SELECT ex_id || direction AS k, hc, rc FROM hr_tok)', 'k', [], 'hc', 'rc', 6), [])})""")


@register("ag11_eval_summary", AG11_SQL)
def ag11_eval_summary(spark, d):
    return M.eval_summary(hyp_ref(spark, d))


@register("ag12_rescore_stored", AG11_SQL)
def ag12_rescore_stored(spark, d):
    """IO12 writes records + summary row; IO13 reads them back skipping the summary; AG12 rescores."""
    path = scratch_path(spark, "eval")
    recs = hyp_ref(spark, d)
    IO.write_eval_jsonl(recs, M.eval_summary(recs), path)
    return M.eval_summary(IO.read_eval_jsonl(spark, path))


# ------------------------------------------------------------------ EV1
@register("ev1_output_analysis", O.with_views(["hyp_ref"], f"""
    SELECT direction, n, empty, runaway, mixed, round(100.0 * empty / greatest(1, n), 6) AS empty_pct,
           round(100.0 * runaway / greatest(1, n), 6) AS runaway_pct, round(100.0 * mixed / greatest(1, n), 6) AS mixed_pct,
           round(median_tok, 6) AS median_tok, round(mean_tok, 6) AS mean_tok
    FROM (SELECT direction, count(*) AS n, count_if(gen_tok <= 1) AS empty, count_if(gen_tok >= 256) AS runaway,
                 count_if({O.has_cjk('hyp')} AND regexp_matches(hyp, '[A-Za-z]')) AS mixed,
                 quantile_cont(gen_tok, 0.5) AS median_tok, avg(gen_tok) AS mean_tok
          FROM hyp_ref GROUP BY direction)"""))
def ev1_output_analysis(spark, d):
    return M.output_analysis(hyp_ref(spark, d))


# ------------------------------------------------------------------ EV2
def _scores_sql(rel: str, name: str) -> str:
    g = [name, "direction"]
    return f"""
        SELECT b.{name}, b.direction, b.bleu, c.chrf
        FROM ({sql_bleu(sql_match_stats(rel, 'ex_id', g, 'ht', 'rt', 4), g)}) b
        JOIN ({sql_chrf(sql_match_stats(rel, 'ex_id', g, 'hc', 'rc', 6), g)}) c USING ({name}, direction)"""


@register("ev2_checkpoint_curve", O.with_views(["ck_tok"], f"""
    SELECT direction, arg_max(checkpoint, (bleu, -checkpoint)) AS best_checkpoint, round(max(bleu), 6) AS best_bleu
    FROM ({_scores_sql('ck_tok', 'checkpoint')}) GROUP BY direction"""))
def ev2_checkpoint_curve(spark, d):
    s = scores_by(variants(spark, d, "checkpoint", CHECKPOINTS), ["checkpoint", "direction"])
    return M.checkpoint_curve(s)


@register("ev2_checkpoint_scores", O.with_views(["ck_tok"], f"""
    SELECT checkpoint, direction, round(bleu, 6) AS bleu, round(chrf, 6) AS chrf
    FROM ({_scores_sql('ck_tok', 'checkpoint')})"""))
def ev2_checkpoint_scores(spark, d):
    return scores_by(variants(spark, d, "checkpoint", CHECKPOINTS), ["checkpoint", "direction"])


# ------------------------------------------------------------------ EV4
@register("ev4_system_compare", O.with_views(["sys_tok"], f"""
    SELECT s.system, s.direction, round(s.bleu, 6) AS bleu, round(s.chrf, 6) AS chrf,
           round(s.bleu - b.bleu, 6) AS delta_bleu, round(s.chrf - b.chrf, 6) AS delta_chrf
    FROM ({_scores_sql('sys_tok', 'system')}) s
    LEFT JOIN (SELECT direction, bleu, chrf FROM ({_scores_sql('sys_tok', 'system')}) WHERE system = '{BASELINE}') b
      USING (direction)"""))
def ev4_system_compare(spark, d):
    s = scores_by(variants(spark, d, "system", SYSTEMS), ["system", "direction"])
    return M.compare_systems(s, BASELINE)


# ------------------------------------------------------------------ U4 / J7 / EV5 / AG13
_TABLE = str.maketrans(X.LETTERS, X.PSEUDO_CJK)


def toy_translator():
    """Deterministic stand-in model: en2zh -> pseudo-Chinese of the source, zh2en -> source unchanged."""
    def fn(src: pd.Series, direction: pd.Series) -> pd.Series:
        out = [s.replace(" ", "").lower().translate(_TABLE) if dr == "en2zh" else s
               for s, dr in zip(src.fillna(""), direction)]
        return pd.Series(out)
    return fn


def toy_scorer():
    """Deterministic stand-in quality model: hypothesis / reference length ratio."""
    def fn(b: pd.DataFrame) -> pd.Series:
        return b["hyp"].fillna("").str.len() / b["ref"].fillna("").str.len().clip(lower=1)
    return fn


_PSEUDO_SQL = f"translate(lower(replace(src, ' ', '')), '{X.LETTERS}', '{X.PSEUDO_CJK}')"
O.add_view("translated", ["directed_clean"], f"""
    SELECT ex_id, direction, src, CASE WHEN direction = 'en2zh' THEN {_PSEUDO_SQL} ELSE src END AS hyp
    FROM directed_clean""")


@register("u4_translate", O.with_views(["translated"], f"""
    SELECT ex_id, direction, src, hyp, CAST({O.word_count('hyp')} AS INTEGER) AS gen_tok FROM translated"""))
def u4_translate(spark, d):
    return M.translate_with(directed_clean(spark, d), toy_translator)


@register("j7_zip_by_key", O.with_views(["translated", "directed_clean"], """
    SELECT t.ex_id, t.direction, t.src, t.hyp, d.tgt AS ref FROM translated t
    JOIN directed_clean d USING (ex_id, direction)"""))
def j7_zip_by_key(spark, d):
    dc = directed_clean(spark, d)
    hyps = M.translate_with(dc, toy_translator).select("ex_id", "direction", "src", "hyp")
    refs = dc.select("ex_id", "direction", F.col("tgt").alias("ref"))
    return M.zip_by_key(hyps, refs, "ex_id", "direction")


@register("ag13_model_score", O.with_views(["hyp_ref"], """
    SELECT direction, round(avg(length(hyp) / greatest(1, length(ref))), 6) AS score FROM hyp_ref GROUP BY direction"""))
def ag13_model_score(spark, d):
    return M.corpus_model_score(hyp_ref(spark, d), toy_scorer, group_cols=["direction"])


@register("ev5_synthetic_mix", O.with_views(["accepted", "calib"], f"""
    SELECT 'public' AS origin, en AS src, zh AS tgt FROM accepted
    UNION ALL
    SELECT 'synthetic', src, tgt FROM (
        SELECT {O.norm('segment')} AS src, {O.norm(_PSEUDO_SQL.replace('src', 'segment'))} AS tgt FROM calib)
    WHERE {O.keep_pred('src', 'tgt')}"""))
def ev5_synthetic_mix(spark, d):
    from parley.plans.queries_corpus import accepted
    seg = C.calib_segments(X.table(spark, d, "documents"))
    seg = seg.select(F.col("doc_id").alias("ex_id"), "pos", F.col("segment").alias("src"),
                     F.lit("en2zh").alias("direction"))
    syn = M.translate_with(seg, toy_translator, keep=["ex_id", "pos"]).select("src", F.col("hyp").alias("tgt"))
    public = accepted(spark, d).select(F.col("en").alias("src"), F.col("zh").alias("tgt"))
    return M.mix_synthetic(public, syn).select("origin", "src", "tgt")
