"""Checked queries for the vocabulary lifecycle and sequence operators
(AG1, SK1-SK3, W4, W5, AG3-AG8, SO1, SO2, J1, J2, J4, PF15-PF17, SQ1-SQ7, SQ11, W10, U1, U2)."""
from __future__ import annotations

from pyspark.sql import functions as F

from parley.functions.tokenize import CODEPOINT, UTF8, decode_ids, piece_table
from parley.operators import corpus as C
from parley.operators import sequences as S
from parley.operators import vocab as V
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.streaming.rowwise import through_stream
from parley.plans.queries_corpus import accepted, built

SPECIAL = [0, 1, 2, 3]           # special ids of the fixture vocabulary
EOS_OLD, UNK_OLD, PAD_OLD = 2, 1, 0
SMALL_VOCAB = 60                 # budget of the audit map
POLICY_VOCAB = 80                # budget of the SK3 keep set
COVER_NS = (10, 20, 50, 100)
MAX_LEN = 410                    # two sides of at most 200 characters, the direction tag and eos
TAIL_LEN = 64                    # the cut shown by sq5_tail_cut alone
SAMPLES = 10

cp = O.codepoints
_specials = "(SELECT * FROM (VALUES " + ", ".join(f"({i})" for i in SPECIAL) + ") t(token_id))"


def _texts_sql(rel: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {c} AS text FROM {rel}" for c in cols)


def _freq_sql(rel: str, cols: list[str]) -> str:
    return (f"SELECT token_id, count(*) AS freq FROM (SELECT unnest({cp('text')}) AS token_id "
            f"FROM ({_texts_sql(rel, cols)})) GROUP BY token_id")


O.add_view("freq_both", ["directed_clean"], _freq_sql("directed_clean", ["src", "tgt"]))
O.add_view("vmap_small", ["freq_both"], f"""
    SELECT token_id AS old_id, CAST(row_number() OVER (ORDER BY token_id) - 1 AS INTEGER) AS new_id FROM (
        SELECT token_id FROM {_specials}
        UNION ALL
        SELECT token_id FROM (SELECT token_id, row_number() OVER (ORDER BY freq DESC, token_id) AS rn
                              FROM freq_both WHERE token_id NOT IN (SELECT token_id FROM {_specials}))
        WHERE rn <= {SMALL_VOCAB - len(SPECIAL)})""")
O.add_view("force_ids", ["accepted"], f"SELECT DISTINCT unnest({cp('zh')}) AS token_id FROM accepted")
O.add_view("calib_freq", ["calib"], _freq_sql("calib", ["segment"]))
O.add_view("keep_policy", ["force_ids", "calib_freq"], f"""
    SELECT token_id, reason FROM (
        SELECT token_id, CASE WHEN min(r) = 0 THEN 'special' ELSE 'force' END AS reason
        FROM (SELECT token_id, 0 AS r FROM {_specials} UNION ALL SELECT token_id, 1 FROM force_ids)
        GROUP BY token_id)
    UNION ALL
    SELECT token_id, 'fill' FROM (
        SELECT token_id, row_number() OVER (ORDER BY freq DESC, token_id) AS rn FROM calib_freq
        WHERE token_id NOT IN (SELECT token_id FROM {_specials} UNION SELECT token_id FROM force_ids))
    WHERE rn <= {POLICY_VOCAB} - (SELECT count(*) FROM (SELECT token_id FROM {_specials}
                                                      UNION SELECT token_id FROM force_ids))""")
O.add_view("freq_built", ["built"], _freq_sql("built", ["src", "tgt"]))
# long form of target code points of the dirty directed rows against the audit map
O.add_view("tgt_tokens", ["directed_dirty", "vmap_small"], f"""
    SELECT t.ex_id, t.direction, t.pos, t.token_id, m.new_id IS NULL AS oov FROM (
        SELECT ex_id, direction, CAST(u.o - 1 AS INTEGER) AS pos, u.v AS token_id
        FROM directed_dirty, unnest({cp('tgt')}) WITH ORDINALITY AS u(v, o)) t
    LEFT JOIN vmap_small m ON m.old_id = t.token_id""")
O.add_view("zh_tokens", ["pairs_clean", "vmap_small"], f"""
    SELECT t.ex_id, t.pos, t.token_id, t.ch, m.new_id FROM (
        SELECT doc_id * {X.LINE_BASE} + line_no AS ex_id, CAST(u.o - 1 AS INTEGER) AS pos,
               CAST(unicode(u.v) AS INTEGER) AS token_id, u.v AS ch
        FROM pairs_clean, unnest(CASE WHEN length(zh) = 0 THEN []::VARCHAR[] ELSE string_split(zh, '') END)
             WITH ORDINALITY AS u(v, o)) t
    LEFT JOIN vmap_small m ON m.old_id = t.token_id""")
O.add_view("zh_ids", ["pairs_clean"], f"SELECT doc_id * {X.LINE_BASE} + line_no AS ex_id FROM pairs_clean")


def special(spark):
    return V.ids_table(spark, SPECIAL)


def directed_clean(spark, d):
    return X.directed(X.pairs_clean(spark, d))


def freq_both(spark, d):
    return V.token_freq(V.both_sides(directed_clean(spark, d)), CODEPOINT)


def vmap_small(spark, d):
    return V.build_keep_ids(freq_both(spark, d), special(spark), SMALL_VOCAB)


def policy(spark, d):
    corpus = accepted(spark, d).select(F.col("zh").alias("text"))
    calib = C.calib_segments(X.table(spark, d, "documents")).select(F.col("segment").alias("text"))
    return V.keep_policy(corpus, calib, special(spark), POLICY_VOCAB, CODEPOINT)


def zh_ids(spark, d):
    p = X.pairs_clean(spark, d)
    return p.select(X.ex_id(), CODEPOINT.encode(F.col("zh")).alias("ids"))


def ids_str(c: str, alias: str | None = None):
    return F.array_join(F.col(c), " ").alias(alias or c)


# ------------------------------------------------------------------ AG1 / IO14 / U1
@register("ag1_token_freq", O.with_views(["freq_both"], "SELECT token_id, freq FROM freq_both"))
def ag1_token_freq(spark, d):
    return freq_both(spark, d)


@register("u1_utf8_byte_freq", O.with_views(["directed_clean"], """
    SELECT token_id, count(*) AS freq FROM (
        SELECT CAST(('0x' || substr(h, 2 * i + 1, 2)) AS INTEGER) AS token_id
        FROM (SELECT hex(encode(text)) AS h FROM (SELECT src AS text FROM directed_clean
                                                   UNION ALL SELECT tgt FROM directed_clean)),
             unnest(range(length(h) // 2)) AS t(i))
    GROUP BY token_id"""))
def u1_utf8_byte_freq(spark, d):
    return V.token_freq(V.both_sides(directed_clean(spark, d)), UTF8)


# ------------------------------------------------------------------ SK1 / SK3 / SO1 / J4
@register("sk3_keep_policy", O.with_views(["keep_policy"], "SELECT token_id, reason FROM keep_policy"))
def sk3_keep_policy(spark, d):
    keep, _ = policy(spark, d)
    return keep


@register("sk1_keep_small", O.with_views(["vmap_small"], """
    SELECT old_id AS token_id, CASE WHEN old_id IN (SELECT token_id FROM """ + _specials + """)
                                    THEN 'special' ELSE 'fill' END AS reason FROM vmap_small"""))
def sk1_keep_small(spark, d):
    return V.select_keep(freq_both(spark, d), special(spark), SMALL_VOCAB)


# ------------------------------------------------------------------ SK2 / W4
@register("w4_vocab_map", O.with_views(["keep_policy"], """
    SELECT token_id AS old_id, CAST(row_number() OVER (ORDER BY token_id) - 1 AS INTEGER) AS new_id
    FROM keep_policy"""))
def w4_vocab_map(spark, d):
    keep, _ = policy(spark, d)
    return V.vocab_map(keep)


# ------------------------------------------------------------------ AG7
@register("ag7_keep_report", O.with_views(["keep_policy", "force_ids"], f"""
    SELECT (SELECT count(*) FROM {_specials}) AS special, (SELECT count(*) FROM force_ids) AS forced,
           (SELECT count(*) FROM keep_policy) AS kept, {POLICY_VOCAB} AS target,
           greatest(0, (SELECT count(*) FROM keep_policy) - (SELECT count(*) FROM
               (SELECT token_id FROM {_specials} UNION SELECT token_id FROM force_ids))) AS reserve"""))
def ag7_keep_report(spark, d):
    keep, force = policy(spark, d)
    return V.keep_report(keep, special(spark), force, POLICY_VOCAB)


# ------------------------------------------------------------------ AG4 / AG5 / W5
@register("ag4_coverage", O.with_views(["directed_clean", "freq_both"], """
    SELECT (SELECT count(*) FROM directed_clean) AS rows, CAST(sum(freq) AS BIGINT) AS total_tokens,
           count(*) AS unique_tokens, count(*) <= 100 AS fits_budget FROM freq_both"""))
def ag4_coverage(spark, d):
    return V.coverage(directed_clean(spark, d), freq_both(spark, d), 100)


@register("ag5_topn_coverage", O.with_views(["freq_both"], f"""
    SELECT top_n, CAST(covered AS BIGINT) AS covered_tokens,
           round(100.0 * covered / greatest(1, total), 6) AS covered_pct,
           CAST(greatest(0, uniq - top_n) AS BIGINT) AS tail_tokens,
           round(100.0 * (1.0 - covered / greatest(1, total)), 6) AS tail_pct
    FROM (SELECT n.top_n, (SELECT sum(freq) FROM freq_both) AS total, (SELECT count(*) FROM freq_both) AS uniq,
                 (SELECT coalesce(sum(freq), 0) FROM (SELECT freq, row_number() OVER (ORDER BY freq DESC, token_id) AS rn
                                                      FROM freq_both) WHERE rn <= n.top_n) AS covered
          FROM (VALUES {', '.join(f'({n})' for n in COVER_NS)}) n(top_n))"""))
def ag5_topn_coverage(spark, d):
    return V.topn_coverage(freq_both(spark, d), COVER_NS)


@register("w5_cumulative_coverage", O.with_views(["freq_both"], """
    SELECT token_id, freq, rank, cum_freq, round(cum_freq / greatest(1, total), 6) AS cum_share FROM (
        SELECT token_id, freq, row_number() OVER w - 1 AS rank,
               CAST(sum(freq) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_freq,
               sum(freq) OVER () AS total
        FROM freq_both WINDOW w AS (ORDER BY freq DESC, token_id))"""))
def w5_cumulative_coverage(spark, d):
    return V.cumulative_coverage(freq_both(spark, d))


# ------------------------------------------------------------------ AG6 / SO2
@register("ag6_map_audit", O.with_views(["vmap_small", "freq_built"], """
    SELECT keep_size, used_size, kept_unused, used_missing,
           CASE WHEN keep_size > 0 THEN round(100.0 * kept_unused / keep_size, 6) END AS kept_unused_pct FROM (
        SELECT (SELECT count(*) FROM vmap_small) AS keep_size, (SELECT count(*) FROM freq_built) AS used_size,
               (SELECT count(*) FROM vmap_small WHERE old_id NOT IN (SELECT token_id FROM freq_built)) AS kept_unused,
               (SELECT count(*) FROM freq_built WHERE token_id NOT IN (SELECT old_id FROM vmap_small)) AS used_missing)"""))
def ag6_map_audit(spark, d):
    used = V.token_freq(V.both_sides(built(spark, d)), CODEPOINT)
    keep = vmap_small(spark, d).select(F.col("old_id").alias("token_id"))
    return V.map_audit(keep, used)


@register("so2_used_missing", O.with_views(["vmap_small", "freq_built"], """
    SELECT token_id FROM freq_built WHERE token_id NOT IN (SELECT old_id FROM vmap_small)"""))
def so2_used_missing(spark, d):
    used = V.token_freq(V.both_sides(built(spark, d)), CODEPOINT)
    keep = vmap_small(spark, d).select(F.col("old_id").alias("token_id"))
    return V.minus(used, keep)


@register("so2_kept_unused", O.with_views(["vmap_small", "freq_built"], """
    SELECT old_id AS token_id FROM vmap_small WHERE old_id NOT IN (SELECT token_id FROM freq_built)"""))
def so2_kept_unused(spark, d):
    used = V.token_freq(V.both_sides(built(spark, d)), CODEPOINT)
    keep = vmap_small(spark, d).select(F.col("old_id").alias("token_id"))
    return V.minus(keep, used)


# ------------------------------------------------------------------ AG3 / PF15 / W10
def _dirty(spark, d):
    from parley.plans.queries_corpus import directed_dirty
    return directed_dirty(spark, d)


@register("ag3_oov_report", O.with_views(["tgt_tokens"], """
    SELECT direction, n, tok, oov, first_oov, round(100.0 * oov / greatest(1, tok), 6) AS oov_pct,
           round(100.0 * first_oov / greatest(1, n), 6) AS first_oov_pct
    FROM (SELECT direction, count_if(pos = 0) AS n, count(*) AS tok, count_if(oov) AS oov,
                 count_if(pos = 0 AND oov) AS first_oov FROM tgt_tokens GROUP BY direction)"""))
def ag3_oov_report(spark, d):
    return S.oov_report(_dirty(spark, d), vmap_small(spark, d), CODEPOINT)


@register("pf15_oov_tokens", O.with_views(["tgt_tokens"], """
    SELECT token_id, count(*) AS n FROM tgt_tokens WHERE oov GROUP BY token_id"""))
def pf15_oov_tokens(spark, d):
    t = S.token_oov(_dirty(spark, d), vmap_small(spark, d), CODEPOINT)
    return t.filter("oov").groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))


@register("w10_first_oov_samples", O.with_views(["tgt_tokens", "directed_dirty"], f"""
    SELECT t.ex_id, t.direction, substr(d.tgt, 1, 50) AS tgt, t.token_id
    FROM tgt_tokens t JOIN directed_dirty d USING (ex_id, direction)
    WHERE t.pos = 0 AND t.oov ORDER BY t.ex_id, t.direction LIMIT {SAMPLES}"""))
def w10_first_oov_samples(spark, d):
    return S.first_oov_samples(_dirty(spark, d), vmap_small(spark, d), CODEPOINT, SAMPLES,
                               ["ex_id", "direction"])


# ------------------------------------------------------------------ SQ1 / J1 / SQ2 / J2
_remap_drop = O.with_views(["zh_ids", "zh_tokens"], """
    SELECT i.ex_id, coalesce(r.ids, '') AS ids FROM zh_ids i LEFT JOIN (
        SELECT ex_id, string_agg(CAST(new_id AS VARCHAR), ' ' ORDER BY pos) AS ids
        FROM zh_tokens WHERE new_id IS NOT NULL GROUP BY ex_id) r USING (ex_id)""")


@register("sq1_remap_drop", _remap_drop)
def sq1_remap_drop(spark, d):
    return S.remap_ids(zh_ids(spark, d), "ids", vmap_small(spark, d)).select("ex_id", ids_str("ids"))


@register("sq1_remap_drop_arrow", _remap_drop)
def sq1_remap_drop_arrow(spark, d):
    return S.remap_ids_arrow(zh_ids(spark, d), "ids", vmap_small(spark, d)).select("ex_id", ids_str("ids"))


_remap_unk = O.with_views(["zh_ids", "zh_tokens"], f"""
    SELECT i.ex_id, coalesce(r.ids, '') AS ids FROM zh_ids i LEFT JOIN (
        SELECT ex_id, string_agg(CAST(coalesce(new_id, {UNK_OLD}) AS VARCHAR), ' ' ORDER BY pos) AS ids
        FROM zh_tokens GROUP BY ex_id) r USING (ex_id)""")


@register("sq1_remap_stream", _remap_drop)
def sq1_remap_stream(spark, d):
    """SQ1 between a file source and a Parquet sink."""
    vm = vmap_small(spark, d)
    out, _ = through_stream(zh_ids(spark, d), lambda x: S.remap_ids(x, "ids", vm), "sq1")
    return out.select("ex_id", ids_str("ids"))


@register("sq1_remap_unk", _remap_unk)
def sq1_remap_unk(spark, d):
    return S.remap_ids(zh_ids(spark, d), "ids", vmap_small(spark, d), unk=UNK_OLD).select("ex_id", ids_str("ids"))


@register("sq1_remap_unk_arrow", _remap_unk)
def sq1_remap_unk_arrow(spark, d):
    return S.remap_ids_arrow(zh_ids(spark, d), "ids", vmap_small(spark, d), unk=UNK_OLD).select(
        "ex_id", ids_str("ids"))


@register("sq2_unmap_roundtrip", O.with_views(["zh_ids", "zh_tokens"], """
    SELECT i.ex_id, coalesce(r.ids, '') AS ids FROM zh_ids i LEFT JOIN (
        SELECT ex_id, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY pos) AS ids
        FROM zh_tokens WHERE new_id IS NOT NULL GROUP BY ex_id) r USING (ex_id)"""))
def sq2_unmap_roundtrip(spark, d):
    vm = vmap_small(spark, d)
    m = S.remap_ids(zh_ids(spark, d), "ids", vm)
    return S.remap_ids(m, "ids", vm, inverse=True).select("ex_id", ids_str("ids"))


# ------------------------------------------------------------------ SQ3 / U2
@register("sq3_decode_mapped", O.with_views(["zh_ids", "zh_tokens"], """
    SELECT i.ex_id, coalesce(r.text, '') AS text FROM zh_ids i LEFT JOIN (
        SELECT ex_id, string_agg(ch, '' ORDER BY pos) AS text
        FROM zh_tokens WHERE new_id IS NOT NULL GROUP BY ex_id) r USING (ex_id)"""))
def sq3_decode_mapped(spark, d):
    vm = vmap_small(spark, d)
    p = X.pairs_clean(spark, d)
    pieces = piece_table(p.select(F.col("zh").alias("text"))).checkpoint()   # vocabulary-sized; counted and collected
    enc = p.select(X.ex_id(), CODEPOINT.encode(F.col("zh")).alias("ids"))
    back = S.remap_ids(S.remap_ids(enc, "ids", vm), "ids", vm, inverse=True)
    return decode_ids(back, "ids", pieces)


# ------------------------------------------------------------------ PF16 / PF17 / SQ4 / SQ5
def row_keyed(df):
    """Unique row key for directed rows: ex_id * 2 + (direction = en2zh)."""
    return df.withColumn("row_id", F.col("ex_id") * 2 + (F.col("direction") == "en2zh").cast("int"))


O.add_view("built_keyed", ["built"], "SELECT *, ex_id * 2 + CAST(direction = 'en2zh' AS INTEGER) AS row_id FROM built")


@register("pf17_render_prompt", O.with_views(["built_keyed"], """
    SELECT row_id, src || chr(10) || '[' || direction || ']' || chr(10) AS prompt FROM built_keyed"""))
def pf17_render_prompt(spark, d):
    return row_keyed(built(spark, d)).select("row_id", S.render_prompt("src", "direction").alias("prompt"))


O.add_view("example_tokens", ["built_keyed", "vmap_small"], f"""
    SELECT t.row_id, t.part, t.pos, t.token_id, m.new_id FROM (
        SELECT row_id, 0 AS part, CAST(u.o - 1 AS INTEGER) AS pos, u.v AS token_id
        FROM built_keyed, unnest({cp("src || chr(10) || '[' || direction || ']' || chr(10)")}) WITH ORDINALITY AS u(v, o)
        UNION ALL
        SELECT row_id, 1 AS part, CAST(u.o - 1 AS INTEGER) AS pos, u.v AS token_id
        FROM built_keyed, unnest({cp('tgt')}) WITH ORDINALITY AS u(v, o)) t
    LEFT JOIN vmap_small m ON m.old_id = t.token_id""")
O.add_view("examples", ["built_keyed", "example_tokens"], f"""
    SELECT row_id, list_slice(p || t || [{EOS_OLD}], 1, {MAX_LEN}) AS input_ids,
           list_slice(list_transform(p, lambda x: -100) || t || [{EOS_OLD}], 1, {MAX_LEN}) AS labels
    FROM (SELECT b.row_id,
                 coalesce((SELECT list(new_id ORDER BY pos) FROM example_tokens e
                           WHERE e.row_id = b.row_id AND e.part = 0 AND new_id IS NOT NULL), []) AS p,
                 coalesce((SELECT list(new_id ORDER BY pos) FROM example_tokens e
                           WHERE e.row_id = b.row_id AND e.part = 1 AND new_id IS NOT NULL), []) AS t
          FROM built_keyed b)""")


def examples(spark, d):
    vm = vmap_small(spark, d)
    return S.build_examples(row_keyed(built(spark, d)), vm, CODEPOINT, EOS_OLD, MAX_LEN, key="row_id")


_sq5 = O.with_views(["examples"], """
    SELECT row_id, array_to_string(input_ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels
    FROM examples""")


@register("sq5_build_examples", _sq5)
def sq5_build_examples(spark, d):
    return examples(spark, d).select("row_id", ids_str("input_ids"), ids_str("labels"))


@register("sq5_build_examples_arrow", _sq5)
def sq5_build_examples_arrow(spark, d):
    return examples(spark, d).select("row_id", ids_str("input_ids"), ids_str("labels"))


@register("sq5_examples_stream", _sq5)
def sq5_examples_stream(spark, d):
    """SQ5 between a file source and a Parquet sink."""
    vm = vmap_small(spark, d)
    out, _ = through_stream(row_keyed(built(spark, d)), lambda x: S.build_examples(x, vm, CODEPOINT, EOS_OLD, MAX_LEN, key="row_id"), "sq5")
    return out.select("row_id", ids_str("input_ids"), ids_str("labels"))


@register("sq11_target_positions", O.with_views(["examples"], """
    SELECT row_id, array_to_string(list_filter(range(1, len(labels)), lambda p: labels[p + 1] <> -100), ' ')
           AS positions FROM examples"""))
def sq11_target_positions(spark, d):
    return examples(spark, d).select("row_id", F.array_join(S.target_positions("labels"), " ").alias("positions"))


# ------------------------------------------------------------------ SQ6 / SQ7 / AG8
O.add_view("old_examples", ["built_keyed"], f"""
    SELECT row_id, list_slice(p || t || [{EOS_OLD}], 1, {MAX_LEN}) AS input_ids,
           list_slice(list_transform(p, lambda x: -100) || t || [{EOS_OLD}], 1, {MAX_LEN}) AS labels
    FROM (SELECT row_id, {cp("src || chr(10) || '[' || direction || ']' || chr(10)")} AS p, {cp('tgt')} AS t
          FROM built_keyed)""")


def old_encoded(rows, keep=("row_id",)):
    """Examples in old ids, row by row from keyed directed rows."""
    p = CODEPOINT.encode(S.render_prompt("src", "direction"))
    t = F.concat(CODEPOINT.encode(F.col("tgt")), F.array(F.lit(EOS_OLD)))
    inp, lab = S.assemble_labels(p, t)
    return rows.select(*keep, F.slice(inp, 1, MAX_LEN).alias("input_ids"), F.slice(lab, 1, MAX_LEN).alias("labels"))


def old_texts(spark, d):
    """The rows of ``old_examples`` before they are encoded: a quarter of the bytes or less."""
    return row_keyed(built(spark, d)).select("row_id", "src", "tgt", "direction")


def old_examples(spark, d):
    return old_encoded(old_texts(spark, d))


@register("sq4_assemble_labels", O.with_views(["old_examples"], """
    SELECT row_id, array_to_string(input_ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels
    FROM old_examples"""))
def sq4_assemble_labels(spark, d):
    return old_examples(spark, d).select("row_id", ids_str("input_ids"), ids_str("labels"))


@register("sq5_tail_cut", O.with_views(["old_examples"], f"""
    SELECT row_id, array_to_string(list_slice(input_ids, 1, {TAIL_LEN}), ' ') AS input_ids,
           array_to_string(list_slice(labels, 1, {TAIL_LEN}), ' ') AS labels FROM old_examples"""))
def sq5_tail_cut(spark, d):
    e = old_examples(spark, d)
    return e.select("row_id", F.array_join(F.slice("input_ids", 1, TAIL_LEN), " ").alias("input_ids"),
                    F.array_join(F.slice("labels", 1, TAIL_LEN), " ").alias("labels"))


_sq6 = O.with_views(["old_examples", "vmap_small"], f"""
    SELECT e.row_id,
      array_to_string(list_transform(e.input_ids, lambda x: coalesce(map_extract_value(mm.m, x), {UNK_OLD})), ' ')
          AS input_ids,
      array_to_string(list_transform(e.labels, lambda x: CASE WHEN x = -100 THEN -100
          ELSE coalesce(map_extract_value(mm.m, x), {UNK_OLD}) END), ' ') AS labels
    FROM old_examples e, (SELECT map(list(old_id), list(new_id)) AS m FROM vmap_small) mm""")


@register("sq6_export_remap", _sq6)
def sq6_export_remap(spark, d):
    vm = vmap_small(spark, d)
    _, oov = S.choose_oov_id(vm, EOS_OLD, UNK_OLD, PAD_OLD)
    r = S.export_remap(old_examples(spark, d), vm, oov, key="row_id")
    return r.select("row_id", ids_str("input_ids"), ids_str("labels"))


@register("sq6_export_stream", _sq6)
def sq6_export_stream(spark, d):
    """SQ6 between a file source and a Parquet sink."""
    vm = vmap_small(spark, d)
    _, oov = S.choose_oov_id(vm, EOS_OLD, UNK_OLD, PAD_OLD)
    out, _ = through_stream(old_examples(spark, d), lambda x: S.export_remap(x, vm, oov, key="row_id"), "sq6")
    return out.select("row_id", ids_str("input_ids"), ids_str("labels"))


@register("ag8_oov_hits", O.with_views(["old_examples", "vmap_small"], """
    SELECT count(*) AS target_tokens, count_if(old_id IS NULL) AS oov_hits FROM (
        SELECT unnest(labels) AS x FROM old_examples) l
    LEFT JOIN vmap_small m ON m.old_id = l.x WHERE l.x <> -100"""))
def ag8_oov_hits(spark, d):
    return S.oov_hits(old_examples(spark, d), vmap_small(spark, d))
