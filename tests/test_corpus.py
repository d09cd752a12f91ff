import pytest
from pyspark.sql import functions as F

from parley.operators import corpus as C
from parley.operators import profile as P
from parley.sources import registry as R


def pairs(spark, rows):
    return spark.createDataFrame(rows, "src string, tgt string")


def test_clean_pair_collapses_unicode_whitespace(spark):
    df = pairs(spark, [("  a\t　b   ", " x\x1c  y\n")])
    r = C.clean_pair(df).first()
    assert (r.src, r.tgt) == ("a b", "x y")


def test_filter_pairs_drops_empty_and_ratio_outliers(spark):
    df = pairs(spark, [("hello", "你好你好"), ("", "空"), ("a", "long long long long text"), ("ok ok", "好的")])
    kept = {tuple(r) for r in C.filter_pairs(df, min_len=1, max_len=200, max_ratio=4.0).collect()}
    assert kept == {("hello", "你好你好"), ("ok ok", "好的")}


def test_keep_bounds_are_inclusive(spark):
    df = pairs(spark, [("ab", "abcdefgh"), ("ab", "abcdefghi"), ("a", "bcde"), ("a", "bcdef"), ("", "")])
    got = [r.k for r in df.select(C.keep_predicate("src", "tgt", 1, 8, 4.0).alias("k")).collect()]
    # length 8 and ratio 4.0 are kept; length 9 or ratio 5.0 or empty are not
    assert got == [True, False, True, False, False]


def test_fan_out_and_pair_key(spark):
    df = spark.createDataFrame([(1, "中", "en")], "id int, zh string, en string")
    d = C.fan_out(df, keep=["id"]).orderBy("direction")
    rows = [tuple(r) for r in d.collect()]
    assert rows == [(1, "en", "中", "en2zh"), (1, "中", "en", "zh2en")]
    keys = {tuple(r) for r in C.pair_key(d).collect()}
    assert keys == {("中", "en")}


def test_unique_pairs_collapses_both_directions(spark):
    df = spark.createDataFrame([("中", "en", "zh2en"), ("en", "中", "en2zh"), ("x", "y", "weird")],
                               "src string, tgt string, direction string")
    got = {tuple(r) for r in C.unique_pairs(df).collect()}
    assert got == {("中", "en"), ("y", "x")}   # unknown direction treated as en2zh


def test_split_is_disjoint_and_sized(spark):
    rows = [(f"中{i}", f"en{i}", "zh2en") for i in range(50)] + [(f"en{i}", f"中{i}", "en2zh") for i in range(50)]
    d = spark.createDataFrame(rows, "src string, tgt string, direction string")
    train, test, n_test = C.split_pairs(d, test_size=20, seed=1)
    assert n_test == 10                       # min(test_size, 50 // 5)
    assert test.count() == 10 and train.count() == 40
    C.assert_disjoint(train, test)
    rep = C.split_report(C.label_split(d, 20, 1)).first()
    assert (rep.unique_pairs, rep.train, rep.test) == (50, 40, 10)
    test_rows = C.members(d, test, "left_semi")
    assert test_rows.count() == 20            # both directions of every test pair


def test_assert_disjoint_raises(spark):
    a = spark.createDataFrame([("z", "e")], "zh string, en string")
    with pytest.raises(AssertionError):
        C.assert_disjoint(a, a)


@pytest.mark.parametrize("salt", [0, 4])
def test_quota_per_source(spark, salt):
    rows = [("s0", i, f"z{i}", f"e{i}") for i in range(10)] + [("s1", i, f"z{i}", f"e{i}") for i in range(10)]
    acc = spark.createDataFrame(rows, "source string, line int, zh string, en string")
    src = spark.createDataFrame([("s0", "spoken"), ("s1", "general")], "source string, kind string")
    t = C.quota_targets(10, 0.7)
    assert t == {"spoken": 7, "general": 3}
    q = C.apply_quota(acc, src, t, ["line"], salt_buckets=salt)
    got = {(r.source, r.line) for r in q.collect()}
    assert got == {("s0", i) for i in range(7)} | {("s1", i) for i in range(3)}
    counts = {(r.source, r.pairs, r.rows) for r in C.source_counts(q).collect()}
    assert ("__total__", 10, 20) in counts and ("s0", 7, 14) in counts


def test_calib_segments_and_per_lang(spark):
    docs = spark.createDataFrame([(1, "en", "short\n  a   long enough segment here \nanother long segment text"),
                                  (2, "fr", "un segment assez long pour passer")], "doc_id long, lang string, text string")
    seg = C.calib_segments(docs, min_chars=16)
    assert [r.segment for r in seg.orderBy("doc_id", "pos").collect()] == [
        "a long enough segment here", "another long segment text", "un segment assez long pour passer"]
    top = C.per_lang_limit(seg, 1)
    assert {(r.lang, r.pos) for r in top.collect()} == {("en", 1), ("fr", 0)}


def test_adapters_and_status(spark):
    nested = spark.createDataFrame([(("hi", "嗨"),), ((None, "空"),)], "translation struct<en:string,zh:string>")
    flat = spark.createDataFrame([("yes", "是")], "english string, non_english string")
    specs = [R.SourceSpec("a", lambda: nested, "translation", "general"),
             R.SourceSpec("b", lambda: flat, "st_pair", "spoken"),
             R.SourceSpec("c", lambda: spark.read.parquet("/nonexistent/x.parquet"), "st_pair", "spoken"),
             R.SourceSpec("d", lambda: flat, "unknown_tag", "spoken")]
    rows, status = R.load_sources(specs)
    got = sorted((r.sid, r.en, r.zh) for r in rows.collect())
    assert got == [("a", "", "空"), ("a", "hi", "嗨"), ("b", "yes", "是"), ("d", "", "")]
    st = {r.source: (r.status, r.rows) for r in status.collect()}
    assert st == {"a": ("ok", 2), "b": ("ok", 1), "c": ("skip", 0), "d": ("ok", 1)}
    assert R.require_rows(status) == 4


def test_profile_counts(spark):
    rows = [("hello world", "", "en2zh"), ("hi", "...!?", "en2zh"), ("same", " same ", "zh2en"),
            ("x", "中文", "zh2en"), ("y", "english only", "en2zh"), ("z", "word", "zh2en")]
    df = spark.createDataFrame(rows, "src string, tgt string, direction string")
    prof = {r.direction: r for r in P.quality_profile(df).collect()}
    en2zh, zh2en, tot = prof["en2zh"], prof["zh2en"], prof["__all__"]
    assert (en2zh.n, en2zh.empty_tgt, en2zh.punct_only_tgt, en2zh.tgt_not_zh) == (3, 1, 2, 2)
    assert en2zh.ultrashort_tgt == 1          # only the empty target is <= 1 character
    assert (zh2en.src_eq_tgt, zh2en.tgt_has_cjk, zh2en.ultrashort_tgt) == (1, 1, 3)
    assert tot.n == 6 and tot.tgt_chars == en2zh.tgt_chars + zh2en.tgt_chars
    assert abs(en2zh.pct_empty_tgt - 100 / 3) < 1e-9


def test_bad_samples_first_n_per_tag(spark):
    rows = [(i, "s", "", "en2zh") for i in range(5)]
    df = spark.createDataFrame(rows, "ex_id int, src string, tgt string, direction string")
    s = P.bad_samples(df, 2, ["ex_id", "direction"])
    got = sorted((r.tag, r.ex_id) for r in s.collect())
    assert got == [("empty_tgt", 0), ("empty_tgt", 1), ("punct_only_tgt", 0), ("punct_only_tgt", 1)]


def test_null_side_does_not_leak_between_splits(spark):
    from parley.operators import corpus as C
    rows = [(None, f"t{i}", "zh2en") for i in range(10)] + [(f"t{i}", None, "en2zh") for i in range(10)] + [(f"s{i}", f"t{i}", "zh2en") for i in range(10)]
    df = spark.createDataFrame(rows, "src string, tgt string, direction string")
    out = C.label_split(df, 4, 1).collect()
    assert len(out) == 20 and len({(r.zh, r.en) for r in out}) == 20 and all(r.zh is not None for r in out)


def test_quota_by_kind_in_one_pass(spark):
    from pyspark.sql import functions as F
    from parley.operators import corpus as C
    rows = spark.range(90).select(F.concat(F.lit("s"), F.col("id") % 3).alias("source"), "id")
    kinds = spark.createDataFrame([("s0", "spoken"), ("s1", "general"), ("s2", "other")], "source string, kind string")
    got = C.apply_quota(rows, kinds, {"spoken": 5, "general": 2}, ["id"])
    assert sorted((r.source, r.id) for r in got.collect()) == [("s0", i) for i in (0, 3, 6, 9, 12)] + [("s1", 1), ("s1", 4)]


def test_any_loader_failure_is_skipped(spark):
    import pytest
    from parley.sources import registry as R

    def broken():
        raise ValueError("not a table")
    good = R.SourceSpec("a", lambda: spark.createDataFrame([("e", "z")], "english string, non_english string"), "st_pair", "spoken")
    rows, status = R.load_sources([R.SourceSpec("b", broken, "st_pair", "general"), R.file_source(spark, "c", "/nowhere/at/all", "parquet", "st_pair", "general"), good])
    assert rows.count() == 1 and {(r.source, r.status) for r in status.collect()} == {("a", "ok"), ("b", "skip"), ("c", "skip")}
    assert R.require_rows(status) == 1
    with pytest.raises(RuntimeError):
        R.require_rows(status.filter("source <> 'a'"))
