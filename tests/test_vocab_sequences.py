import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.functions.text import words
from parley.functions.tokenize import CODEPOINT, UTF8, Tokenizer, decode_ids, piece_table
from parley.operators import sequences as S
from parley.operators import vocab as V

WORD_LEN = Tokenizer("word_len", lambda c: F.transform(words(c), lambda w: F.length(w)))


def freq_of(spark, d):
    return spark.createDataFrame(list(d.items()), "token_id int, freq long")


def keep_ids(df):
    return {r.token_id for r in df.collect()}


def test_token_freq_with_injected_encoder(spark):
    texts = spark.createDataFrame([("kiwi fig fig",), ("date plum",)], "text string")
    got = {r.token_id: r.freq for r in V.token_freq(texts, WORD_LEN).collect()}
    assert got == {3: 2, 4: 3}


def test_codepoint_and_utf8_tokenizers(spark):
    df = spark.createDataFrame([("a中😀",), ("",)], "t string")
    r = df.select(CODEPOINT.encode(F.col("t")).alias("c"), UTF8.encode(F.col("t")).alias("u")).collect()
    assert r[0].c == [97, 20013, 128512] and r[1].c == []
    assert r[0].u == list("a中😀".encode("utf-8")) and r[1].u == []


def test_keep_special_then_topk(spark):
    keep = V.select_keep(freq_of(spark, {41: 9, 37: 6, 52: 2, 60: 2, 33: 1}), V.ids_table(spark, [3, 8]), 5)
    ids = keep_ids(keep)
    assert {3, 8, 41, 37, 52} == ids


def test_keep_force_always_retained(spark):
    keep = V.select_keep(freq_of(spark, {21: 30, 22: 12}), V.ids_table(spark, [4]), 4,
                         force=V.ids_table(spark, [70, 71]))
    ids = keep_ids(keep)
    assert {70, 71, 4, 21} == ids
    reasons = {r.token_id: r.reason for r in keep.collect()}
    assert reasons[4] == "special" and reasons[70] == "force" and reasons[21] == "fill"


def test_keep_overflow_beats_budget(spark):
    keep = V.select_keep(freq_of(spark, {15: 8, 16: 5}), V.ids_table(spark, [6, 9]), 3,
                         force=V.ids_table(spark, [80, 81]))
    assert keep_ids(keep) == {6, 9, 80, 81}


def test_keep_tie_rule_lower_id_first(spark):
    keep = V.select_keep(freq_of(spark, {64: 7, 18: 7, 29: 7, 90: 7}), V.ids_table(spark, []), 3)
    assert keep_ids(keep) == {18, 29, 64}


def test_vocab_map_dense_ascending_roundtrip(spark):
    keep = V.ids_table(spark, [34, 5, 19])
    vm = {r.old_id: r.new_id for r in V.vocab_map(keep).collect()}
    assert vm == {5: 0, 19: 1, 34: 2}


def test_coverage_reports(spark):
    f = freq_of(spark, {1: 5, 2: 3, 3: 2})
    cov = {r.top_n: r for r in V.topn_coverage(f, (1, 2, 5)).collect()}
    assert cov[1].covered_tokens == 5 and abs(cov[1].covered_pct - 50.0) < 1e-9 and cov[1].tail_tokens == 2
    assert cov[5].tail_tokens == 0 and abs(cov[5].tail_pct) < 1e-9
    cum = [(r.token_id, r.cum_freq) for r in V.cumulative_coverage(f).orderBy("rank").collect()]
    assert cum == [(1, 5), (2, 8), (3, 10)]
    rows = f.select(F.lit(1).alias("x"))
    c = V.coverage(rows, f, 2).first()
    assert (c.rows, c.total_tokens, c.unique_tokens, c.fits_budget) == (3, 10, 3, False)


def test_map_audit_and_empty_keep(spark):
    a = V.map_audit(V.ids_table(spark, [1, 2, 3]), V.ids_table(spark, [2, 3, 4, 5])).first()
    assert (a.keep_size, a.kept_unused, a.used_missing) == (3, 1, 2)
    assert abs(a.kept_unused_pct - 100 / 3) < 1e-9
    e = V.map_audit(V.ids_table(spark, []), V.ids_table(spark, [2])).first()
    assert e.keep_size == 0 and e.kept_unused_pct is None


def test_keep_report(spark):
    keep, force = V.keep_policy(spark.createDataFrame([("ab",)], "text string"),
                                spark.createDataFrame([("zzz y",)], "text string"),
                                V.ids_table(spark, [0]), 5, CODEPOINT)
    assert keep_ids(keep) == {0, ord("a"), ord("b"), ord("z"), ord(" ")}
    r = V.keep_report(keep, V.ids_table(spark, [0]), force, 5).first()
    assert (r.special, r.forced, r.kept, r.target, r.reserve) == (1, 2, 5, 5, 2)


VMAP = [(31, 2), (88, 0), (45, 3), (62, 1)]


@pytest.fixture
def vmap(spark):
    return spark.createDataFrame(VMAP, "old_id int, new_id int")


@pytest.fixture
def seqs(spark):
    return spark.createDataFrame([(1, [45, 31, 31, 88]), (2, [12, 62, 12]), (3, []), (4, [12, 12]), (5, [62])],
                                 "ex_id long, ids array<int>")


@pytest.mark.parametrize("arrow", [False, True])
def test_remap_drop_unk_and_roundtrip(spark, vmap, seqs, arrow):
    fn = (lambda df, **kw: S.remap_ids_arrow(df, "ids", vmap, **kw)) if arrow else \
         (lambda df, **kw: S.remap_ids(df, "ids", vmap, **kw))
    drop = {r.ex_id: r.ids for r in fn(seqs).collect()}
    assert drop == {1: [3, 2, 2, 0], 2: [1], 3: [], 4: [], 5: [1]}
    unk = {r.ex_id: r.ids for r in fn(seqs, unk=9).collect()}
    assert unk == {1: [3, 2, 2, 0], 2: [9, 1, 9], 3: [], 4: [9, 9], 5: [1]}
    back = {r.ex_id: r.ids for r in fn(fn(seqs), inverse=True).collect()}
    assert back == {1: [45, 31, 31, 88], 2: [62], 3: [], 4: [], 5: [62]}


def test_unmap_unknown_new_id_raises(spark, vmap):
    df = spark.createDataFrame([(1, [0, 55])], "ex_id long, ids array<int>")
    with pytest.raises(Exception):
        S.remap_ids(df, "ids", vmap, inverse=True).collect()


def test_assemble_and_prompt(spark):
    df = spark.createDataFrame([([5, 6, 7], [10, 11], "你好", "zh2en")],
                               "p array<int>, t array<int>, src string, direction string")
    inp, lab = S.assemble_labels("p", "t")
    r = df.select(inp.alias("i"), lab.alias("l"), S.render_prompt("src", "direction").alias("pr")).first()
    assert r.i == [5, 6, 7, 10, 11] and r.l == [-100, -100, -100, 10, 11]
    assert r.pr == "你好\n[zh2en]\n"
    bad = spark.createDataFrame([("x", "zh2fr")], "src string, direction string")
    with pytest.raises(Exception):
        bad.select(S.render_prompt("src", "direction")).collect()
    good, quarantined = S.quarantine_directions(bad)
    assert good.count() == 0 and quarantined.count() == 1


def test_target_positions(spark):
    df = spark.createDataFrame([([-100, -100, 5, 6],), ([7],), ([],), ([1, -100, 3],)], "l array<int>")
    got = [r.p for r in df.select(S.target_positions("l").alias("p")).collect()]
    assert got == [[2, 3], [], [], [2]]


def test_build_examples_truncates_and_appends_eos(spark):
    vm = spark.createDataFrame([(ord(c), i) for i, c in enumerate("ab\n[]zhen2")], "old_id int, new_id int")
    df = spark.createDataFrame([(1, "ab", "ba", "zh2en")], "ex_id long, src string, tgt string, direction string")
    r = S.build_examples(df, vm, CODEPOINT, eos_new_id=99, max_len=100).first()
    prompt = [ord(c) for c in "ab\n[zh2en]\n"]
    m = {o: n for o, n in vm.collect()}
    p = [m[x] for x in prompt]
    assert r.input_ids == p + [m[ord("b")], m[ord("a")], 99]
    assert r.labels == [-100] * len(p) + [m[ord("b")], m[ord("a")], 99]
    short = S.build_examples(df, vm, CODEPOINT, eos_new_id=99, max_len=4).first()
    assert len(short.input_ids) == 4 and short.labels == [-100] * 4


def test_export_remap_and_oov_choice(spark, vmap):
    eos_new, oov = S.choose_oov_id(vmap, eos_old=45, unk_old=88, pad_old=None)
    assert (eos_new, oov) == (3, 0)
    eos_new, oov = S.choose_oov_id(vmap, eos_old=45, unk_old=None, pad_old=62)
    assert oov == 1
    with pytest.raises(ValueError):
        S.choose_oov_id(vmap, eos_old=12345, unk_old=None, pad_old=None)
    df = spark.createDataFrame([(1, [88, 12, 45], [-100, 12, 45])], "ex_id long, input_ids array<int>, labels array<int>")
    r = S.export_remap(df, vmap, oov_new=5).first()
    assert r.input_ids == [0, 5, 3] and r.labels == [-100, 5, 3]
    hits = S.oov_hits(df, vmap).first()
    assert (hits.target_tokens, hits.oov_hits) == (2, 1)


def test_oov_report_and_first_samples(spark, vmap):
    tok = Tokenizer("ids", lambda c: F.transform(F.split(c, " "), lambda x: x.cast("int")))
    df = spark.createDataFrame([(1, "12 31", "en2zh"), (2, "88 45", "en2zh"), (3, "13", "zh2en")],
                               "ex_id long, tgt string, direction string")
    rep = {r.direction: r for r in S.oov_report(df, vmap, tok).collect()}
    assert (rep["en2zh"].n, rep["en2zh"].tok, rep["en2zh"].oov, rep["en2zh"].first_oov) == (2, 4, 1, 1)
    assert rep["zh2en"].first_oov == 1 and rep["zh2en"].oov_pct == 100.0
    s = S.first_oov_samples(df, vmap, tok, 5, ["ex_id"]).collect()
    assert [(r.ex_id, r.token_id) for r in s] == [(1, 12), (3, 13)]


def test_decode_with_pieces(spark):
    texts = spark.createDataFrame([("ab中",)], "text string")
    pieces = piece_table(texts)
    ids = spark.createDataFrame([(1, [ord("中"), ord("a")]), (2, [])], "ex_id long, ids array<int>")
    got = {r.ex_id: r.text for r in decode_ids(ids, "ids", pieces).collect()}
    assert got == {1: "中a", 2: ""}


def test_file_tokenizer_in_arrow_batches(spark, tmp_out):
    from tokenizers import Tokenizer as HF, models, pre_tokenizers
    from parley.functions.tokenize import file_tokenizer
    t = HF(models.WordLevel({"[UNK]": 0, "hello": 1, "world": 2}, unk_token="[UNK]"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    path = tmp_out + "/tok.json"
    t.save(path)
    tok = file_tokenizer(path)
    df = spark.createDataFrame([("hello world",), ("hello there",), ("",)], "text string")
    assert [r.ids for r in df.select(tok.encode(F.col("text")).alias("ids")).collect()] == [[1, 2], [1, 0], []]
    freq = {r.token_id: r.freq for r in V.token_freq(df, tok).collect()}
    assert freq == {1: 2, 2: 1, 0: 1}


def test_file_tokenizer_needs_no_path_on_executors(spark, tmp_out):
    import os
    from tokenizers import Tokenizer as HF, models, pre_tokenizers
    from parley.functions.tokenize import file_tokenizer
    df = spark.createDataFrame([("hello world",), (None,)], "text string")
    got = []
    for i, name in enumerate(["a.json", "b.json", "c.json", "a.json"]):  # more contents than a worker keeps, one path used again
        t = HF(models.WordLevel({"[UNK]": 0, "hello": 10 + i, "world": 20 + i}, unk_token="[UNK]"))
        t.pre_tokenizer = pre_tokenizers.Whitespace()
        t.save(f"{tmp_out}/{name}")
        tok = file_tokenizer(f"{tmp_out}/{name}")
        os.remove(f"{tmp_out}/{name}")
        got.append([r.ids for r in df.select(tok.encode(F.col("text")).alias("ids")).collect()])
    assert got == [[[10 + i, 20 + i], []] for i in range(4)]


def test_file_tokenizer_of_a_size_out_of_bounds(spark, tmp_out):
    from parley.functions.tokenize import file_tokenizer
    for content in ("", "x" * 101):
        with open(f"{tmp_out}/t.json", "w") as f:
            f.write(content)
        with pytest.raises(ValueError, match="bytes"):
            file_tokenizer(f"{tmp_out}/t.json", max_bytes=100)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_codepoints_of_a_slice_with_nulls_and_broken_bytes():
    import pyarrow as pa
    from parley.functions.tokenize import codepoints
    texts = pa.array(["skipped", None, "", "aé中😀", "z"]).slice(1)
    ids, sizes = codepoints(texts)
    assert ids.tolist() == [97, 233, 20013, 128512, 122] and sizes.tolist() == [0, 0, 4, 1]
    broken = pa.Array.from_buffers(pa.string(), 2, [None, pa.py_buffer(np.array([0, 2, 4], np.int32)), pa.py_buffer(b"a\xffbc")])
    ids, sizes = codepoints(broken)
    assert ids.tolist() == [97, 0xFFFD, 98, 99] and sizes.tolist() == [2, 2]
    assert [x.tolist() for x in codepoints(pa.array([], pa.string()))] == [[], []]


def test_statistics_make_no_row_for_each_token(spark):
    """Frequencies, pieces and OOV audits are counted by batch or row: no token is exploded or joined."""
    df = spark.createDataFrame([(1, "zh2en", "ab中"), (2, "zh2en", None), (3, "en2zh", "中a"), (4, "en2zh", ""), (5, "none", "")],
                               "ex_id long, direction string, tgt string")
    vm = spark.createDataFrame([(97, 0), (98, 1), (98, 1)], "old_id int, new_id int")
    texts = df.select(F.col("tgt").alias("text"))
    freq, report = V.token_freq(texts, CODEPOINT), S.oov_report(df, vm, CODEPOINT)
    hits = S.oov_hits(spark.createDataFrame([([-100, 97, 5, None],), (None,), ([],)], "labels array<int>"), vm)
    assert {tuple(r) for r in freq.collect()} == {(97, 2), (98, 1), (20013, 2)}
    assert {tuple(r) for r in piece_table(texts).collect()} == {(97, "a"), (98, "b"), (20013, "中")}
    assert {tuple(r)[:5] for r in report.collect()} == {("zh2en", 1, 3, 1, 0), ("en2zh", 1, 2, 1, 1)}
    assert tuple(hits.first()) == (2, 1) and tuple(S.oov_hits(df.limit(0).select(F.array(F.lit(1)).alias("labels")), vm).first()) == (0, 0)
    for d in (freq, piece_table(texts), report, hits):
        assert "Generate" not in plan_of(d) and "Join" not in plan_of(d)


def test_the_length_filter_cleans_each_side_once(spark):
    from parley.operators import corpus as C
    df = spark.createDataFrame([("  a  b ", "中 "), ("", "x"), (None, "x"), ("a" * 9, "x"), ("a" * 8, "xx")], "src string, tgt string")
    kept = C.filter_pairs(df)
    assert {tuple(r) for r in kept.collect()} == {("a b", "中"), ("a" * 8, "xx")}
    below = plan_of(kept).split("Filter", 1)[1]
    assert below.count("regexp_replace") <= 2
