"""Checked queries for the corpus lifecycle (PF*, W1-W3, W9, SO3-SO5, SK4, J3, AG2, AG18, AG19, IO5, IO6)."""
from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators import corpus as C
from parley.operators import profile as P
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.session import scratch_path
from parley.sources import registry as R
from parley.sources import shardstore as SS

QUOTA_TOTAL, QUOTA_RATIO = 400, 0.7
TEST_SIZE, SEED = 2000, 42
PER_LANG = 300
SAMPLES = 5
SHARD_DOCS = 20        # documents of a shard in the sources read until a quota


def directed_dirty(spark, d):
    return X.directed(X.pairs_dirty(spark, d))


def accepted(spark, d):
    """PF1 + PF3 over the dirty pairs (keep(zh, en) as the corpus builder does)."""
    return C.filter_pairs(X.pairs_dirty(spark, d, with_source=True), src="zh", tgt="en")


def built(spark, d):
    return X.directed(accepted(spark, d))


O.add_view("flags_dirty", ["directed_dirty"], f"""
    SELECT ex_id, direction, src, tgt, length(ts) AS tlen,
           length(ts) = 0 AS empty_tgt,
           {O.punct_only('tgt')} AS punct_only_tgt,
           CASE WHEN ends_with(direction, '2zh') THEN length(ts) <= 1 ELSE {O.word_count('tgt')} <= 1 END
               AS ultrashort_tgt,
           ends_with(direction, '2zh') AND length(ts) > 0 AND NOT {O.has_cjk('tgt')} AS tgt_not_zh,
           ends_with(direction, '2en') AND {O.has_cjk('tgt')} AS tgt_has_cjk,
           ss = ts AND length(ss) > 0 AS src_eq_tgt
    FROM (SELECT ex_id, coalesce(direction, '?') AS direction, coalesce(src, '') AS src,
                 coalesce(tgt, '') AS tgt, {O.strip("coalesce(tgt, '')")} AS ts,
                 {O.strip("coalesce(src, '')")} AS ss
          FROM directed_dirty)""")
O.add_view("unique_built", ["built"], """
    SELECT DISTINCT CASE WHEN direction = 'zh2en' THEN src ELSE tgt END AS zh,
                    CASE WHEN direction = 'zh2en' THEN tgt ELSE src END AS en
    FROM built""")
O.add_view("split_built", ["unique_built"], f"""
    SELECT zh, en, CASE WHEN rn <= least({TEST_SIZE}, n // 5) THEN 'test' ELSE 'train' END AS split
    FROM (SELECT zh, en, count(*) OVER () AS n,
                 row_number() OVER (ORDER BY md5('{SEED}' || '|' || zh || '|' || en), zh, en) AS rn
          FROM unique_built)""")
_spoken = int(QUOTA_TOTAL * QUOTA_RATIO)
O.add_view("quota_built", ["accepted", "sources"], f"""
    SELECT source, kind, doc_id, line_no, zh, en FROM (
        SELECT a.*, s.kind, row_number() OVER (PARTITION BY a.source ORDER BY a.doc_id, a.line_no) AS rn
        FROM accepted a JOIN sources s USING (source))
    WHERE rn <= CASE kind WHEN 'spoken' THEN {_spoken} ELSE {QUOTA_TOTAL - _spoken} END""")
O.add_view("calib", [], f"""
    SELECT doc_id, lang, pos, segment FROM (
        SELECT d.doc_id, d.lang, CAST(t.o - 1 AS INTEGER) AS pos, {O.norm('t.v')} AS segment
        FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS t(v, o))
    WHERE length(segment) >= 16""")


# ------------------------------------------------------------------ PF1
@register("pf1_clean_pairs", O.with_views(["pairs_dirty"], f"""
    SELECT doc_id, line_no, {O.norm('en')} AS en, {O.norm('zh')} AS zh FROM pairs_dirty"""))
def pf1_clean_pairs(spark, d):
    return C.clean_pair(X.pairs_dirty(spark, d).select("doc_id", "line_no", "en", "zh"), ("en", "zh"))


# ------------------------------------------------------------------ PF2
@register("pf2_filter_pairs", O.with_views(["accepted"], """
    SELECT doc_id, line_no, zh, en FROM accepted"""))
def pf2_filter_pairs(spark, d):
    return accepted(spark, d).select("doc_id", "line_no", "zh", "en")


# ------------------------------------------------------------------ PF3
@register("pf3_keep_flags", O.with_views(["pairs_dirty"], f"""
    SELECT doc_id, line_no, {O.keep_pred('zh', 'en')} AS keep FROM pairs_dirty"""))
def pf3_keep_flags(spark, d):
    p = X.pairs_dirty(spark, d)
    return p.select("doc_id", "line_no", C.keep_predicate("zh", "en").alias("keep"))


# ------------------------------------------------------------------ PF5
@register("pf5_fan_out", O.with_views(["directed_dirty"], """
    SELECT ex_id, src, tgt, direction FROM directed_dirty"""))
def pf5_fan_out(spark, d):
    return directed_dirty(spark, d)


# ------------------------------------------------------------------ PF6
@register("pf6_pair_key", O.with_views(["directed_dirty"], """
    SELECT ex_id, direction, CASE WHEN direction = 'zh2en' THEN src ELSE tgt END AS zh,
           CASE WHEN direction = 'zh2en' THEN tgt ELSE src END AS en FROM directed_dirty"""))
def pf6_pair_key(spark, d):
    return C.pair_key(directed_dirty(spark, d), keep=["ex_id", "direction"])


# ------------------------------------------------------------------ AG2 (flagship)
_M = P.METRICS
AG2_SQL = O.with_views(["flags_dirty"], f"""
    SELECT direction, n, tgt_chars, {', '.join(_M)},
           round(tgt_chars / greatest(1, n), 6) AS avg_tgt_chars,
           {', '.join(f'round(100.0 * {m} / greatest(1, n), 6) AS pct_{m}' for m in _M)}
    FROM (SELECT CASE WHEN grouping(direction) = 1 THEN '__all__' ELSE direction END AS direction,
                 count(*) AS n, CAST(coalesce(sum(tlen), 0) AS BIGINT) AS tgt_chars,
                 {', '.join(f'count_if({m}) AS {m}' for m in _M)}
          FROM flags_dirty GROUP BY ROLLUP (direction))""")


@register("ag2_quality_profile", AG2_SQL)
def ag2_quality_profile(spark, d):
    return P.quality_profile(directed_dirty(spark, d))


# ------------------------------------------------------------------ PF8-PF14 row flags
@register("pf8_pf14_row_flags", O.with_views(["flags_dirty", "directed_dirty"], f"""
    SELECT f.ex_id, f.direction, {O.has_cjk('d.tgt')} AS tgt_cjk, {', '.join('f.' + m for m in _M)}
    FROM flags_dirty f JOIN directed_dirty d USING (ex_id, direction)"""))
def pf8_pf14_row_flags(spark, d):
    from parley.functions.text import has_cjk
    flags = P.metric_flags()
    return directed_dirty(spark, d).select("ex_id", "direction", has_cjk("tgt").alias("tgt_cjk"),
                                           *[flags[m].alias(m) for m in _M])


# ------------------------------------------------------------------ W9
_tags = [m for m in _M if m != "ultrashort_tgt"]
W9_SQL = O.with_views(["flags_dirty"], f"""
    SELECT tag, rank, ex_id, direction, substr(src, 1, 60) AS src, substr(tgt, 1, 60) AS tgt FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY tag ORDER BY ex_id, direction) AS INTEGER) AS rank
        FROM ({' UNION ALL '.join(f"SELECT ex_id, direction, src, tgt, '{m}' AS tag FROM flags_dirty WHERE {m}"
                                  for m in _tags)}))
    WHERE rank <= {SAMPLES}""")


@register("w9_bad_samples", W9_SQL)
def w9_bad_samples(spark, d):
    return P.bad_samples(directed_dirty(spark, d), SAMPLES, ["ex_id", "direction"])


# ------------------------------------------------------------------ SO3
@register("so3_unique_pairs", O.with_views(["unique_built"], "SELECT zh, en FROM unique_built"))
def so3_unique_pairs(spark, d):
    return C.unique_pairs(built(spark, d))


# ------------------------------------------------------------------ SK4 + J3 + SO4
@register("sk4_split_pairs", O.with_views(["split_built"], "SELECT zh, en, split FROM split_built"))
def sk4_split_pairs(spark, d):
    train, test, _ = C.split_pairs(built(spark, d), TEST_SIZE, SEED)
    C.assert_disjoint(train, test)
    return (train.select("zh", "en", F.lit("train").alias("split"))
            .unionByName(test.select("zh", "en", F.lit("test").alias("split"))))


@register("ag19_split_report", O.with_views(["split_built"], """
    SELECT count(*) AS unique_pairs, count_if(split = 'train') AS train, count_if(split = 'test') AS test
    FROM split_built"""))
def ag19_split_report(spark, d):
    return C.split_report(C.label_split(built(spark, d), TEST_SIZE, SEED))


_J3 = """
    SELECT b.ex_id, b.src, b.tgt, b.direction FROM built b
    WHERE {neg} EXISTS (SELECT 1 FROM split_built s WHERE s.split = 'test'
        AND s.zh = CASE WHEN b.direction = 'zh2en' THEN b.src ELSE b.tgt END
        AND s.en = CASE WHEN b.direction = 'zh2en' THEN b.tgt ELSE b.src END)"""


@register("j3_test_rows", O.with_views(["built", "split_built"], _J3.format(neg="")))
def j3_test_rows(spark, d):
    b = built(spark, d)
    _, test, _ = C.split_pairs(b, TEST_SIZE, SEED)
    return C.members(b, F.broadcast(test), "left_semi")


@register("j3_train_rows", O.with_views(["built", "split_built"], _J3.format(neg="NOT")))
def j3_train_rows(spark, d):
    b = built(spark, d)
    _, test, _ = C.split_pairs(b, TEST_SIZE, SEED)
    return C.members(b, F.broadcast(test), "left_anti")


# ------------------------------------------------------------------ W1 / W2 / AG18
def quota(spark, d, salt_buckets: int | None = None):
    targets = C.quota_targets(QUOTA_TOTAL, QUOTA_RATIO)
    return C.apply_quota(accepted(spark, d), X.sources(spark, d), targets, ["doc_id", "line_no"],
                         salt_buckets=salt_buckets)


@register("w1_source_quota", O.with_views(["quota_built"], """
    SELECT source, kind, doc_id, line_no, zh, en FROM quota_built"""))
def w1_source_quota(spark, d):
    return quota(spark, d).select("source", "kind", "doc_id", "line_no", "zh", "en")


@register("w1_source_quota_salted", O.with_views(["quota_built"], """
    SELECT source, kind, doc_id, line_no, zh, en FROM quota_built"""))
def w1_source_quota_salted(spark, d):
    return quota(spark, d, salt_buckets=8).select("source", "kind", "doc_id", "line_no", "zh", "en")


@register("io5_quota_early_stop", O.with_views(["quota_built"], """
    SELECT source, kind, doc_id, line_no, zh, en FROM quota_built"""))
def io5_quota_early_stop(spark, d):
    """W1 over one folder of shards for each source, read in waves until the source's quota is filled."""
    path = scratch_path(spark, "sources")
    name = F.concat(F.lit("s"), F.coalesce(F.md5("source"), F.lit("none")))
    docs = X.table(spark, d, "documents").select("doc_id", "source", "text", name.alias("name"))
    SS.write_source_folders(docs, path, "name", ["doc_id"], SHARD_DOCS)
    kinds = X.sources(spark, d).select(F.concat(F.lit("name="), name).alias("folder"), "source", "kind")
    targets = C.quota_targets(QUOTA_TOTAL, QUOTA_RATIO)
    wanted = {r["folder"]: targets[r["kind"]] for r in kinds.collect()}  # the registry: one row for each source

    def accept(rows):
        lines = rows.select("folder", "doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "en"))
        pairs = X.inject_defects(lines.withColumn("zh", X.pseudo_zh(F.col("en"))).withColumn("line_no", F.col("line_no").cast("int")))
        return C.filter_pairs(pairs, src="zh", tgt="en")
    rows, _ = SS.read_until_quota(spark, path, wanted, accept, ["doc_id", "line_no"], scratch_path(spark, "quota"),
                                  "doc_id long, source string, text string")
    return rows.join(kinds.select("folder", "kind"), "folder").select("source", "kind", "doc_id", "line_no", "zh", "en")


@register("ag18_source_counts", O.with_views(["quota_built"], """
    SELECT source, kind, count(*) AS pairs, 2 * count(*) AS rows FROM quota_built GROUP BY source, kind
    UNION ALL
    SELECT '__total__', '__total__', count(*), 2 * count(*) FROM quota_built"""))
def ag18_source_counts(spark, d):
    return C.source_counts(quota(spark, d))


# ------------------------------------------------------------------ PF7 / W3
@register("pf7_calib_segments", O.with_views(["calib"], "SELECT doc_id, lang, pos, segment FROM calib"))
def pf7_calib_segments(spark, d):
    return C.calib_segments(X.table(spark, d, "documents"))


@register("w3_calib_per_lang", O.with_views(["calib"], f"""
    SELECT doc_id, lang, pos, segment FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) AS rn FROM calib)
    WHERE rn <= {PER_LANG}"""))
def w3_calib_per_lang(spark, d):
    return C.per_lang_limit(C.calib_segments(X.table(spark, d, "documents")), PER_LANG)


# ------------------------------------------------------------------ PF4 / IO5 / SO5
def _source_frames(spark, d):
    p = X.pairs_clean(spark, d, with_source=True)
    num = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as int)")
    even = F.coalesce(num % 2 == 0, F.lit(False))  # sources without a number are in the flat part
    nested = p.filter(even).select("source", F.struct("en", "zh").alias("translation"))
    flat = p.filter(~even).select("source", F.col("en").alias("english"),
                                         F.col("zh").alias("non_english"))
    return nested, flat


@register("io5_multi_source", O.with_views(["pairs_clean"], """
    SELECT 'nested' AS sid, 'spoken' AS kind, source, en, zh FROM pairs_clean
    WHERE coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 2 = 0, false)
    UNION ALL
    SELECT 'flat', 'general', source, en, zh FROM pairs_clean
    WHERE NOT coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 2 = 0, false)"""))
def io5_multi_source(spark, d):
    nested, flat = _source_frames(spark, d)
    specs = [R.SourceSpec("nested", lambda: nested, "translation", "spoken"),
             R.SourceSpec("flat", lambda: flat, "st_pair", "general")]
    df, _ = R.load_sources(specs, keep=["source"])
    return df.select("sid", "kind", "source", "en", "zh")


@register("io6_source_status", O.with_views(["pairs_clean"], """
    SELECT 'nested' AS source, 'spoken' AS kind, 'ok' AS status, count(*) AS rows FROM pairs_clean
    WHERE coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 2 = 0, false)
    UNION ALL
    SELECT 'flat', 'general', 'ok', count(*) FROM pairs_clean
    WHERE NOT coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 2 = 0, false)
    UNION ALL SELECT 'missing', 'general', 'skip', CAST(0 AS BIGINT)"""))
def io6_source_status(spark, d):
    nested, flat = _source_frames(spark, d)
    specs = [R.SourceSpec("nested", lambda: nested, "translation", "spoken"),
             R.SourceSpec("flat", lambda: flat, "st_pair", "general"),
             R.SourceSpec("missing", lambda: spark.read.parquet(f"{d}/no_such_table.parquet"),
                          "st_pair", "general")]
    _, status = R.load_sources(specs)
    return status
