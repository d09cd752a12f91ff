import json
import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.functions.text import words
from parley.operators import metrics as M
from parley.sources import files as IO


# ------------------------------------------------------------------ brute-force references
def bleu_ref(hyps, refs):
    m, t = [0] * 4, [0] * 4
    hl = rl = 0
    for h, r in zip(hyps, refs):
        hl, rl = hl + len(h), rl + len(r)
        for n in range(1, 5):
            hc = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            rc = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
            m[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            t[n - 1] += max(0, len(h) - n + 1)
    if hl == 0 or any(x == 0 for x in t):
        return 0.0
    k, logs = 0, []
    for n in range(4):
        if m[n] == 0:
            k += 1
            logs.append(math.log(1 / (2 ** k * t[n])))
        else:
            logs.append(math.log(m[n] / t[n]))
    bp = 1.0 if hl >= rl else math.exp(1 - rl / hl)
    return 100 * bp * math.exp(sum(logs) / 4)


def chrf_ref(hyps, refs, order=6, beta=2.0):
    stats = [[0, 0, 0] for _ in range(order)]
    for h, r in zip(hyps, refs):
        h, r = "".join(h.split()), "".join(r.split())
        for n in range(1, order + 1):
            hc = Counter(h[i:i + n] for i in range(len(h) - n + 1))
            rc = Counter(r[i:i + n] for i in range(len(r) - n + 1))
            stats[n - 1][0] += sum(hc.values())
            stats[n - 1][1] += sum(rc.values())
            stats[n - 1][2] += sum(min(c, rc[g]) for g, c in hc.items())
    eps, p, r, eff = 1e-16, 0.0, 0.0, 0
    for nh, nr, nm in stats:
        p += nm / nh if nh > 0 else eps
        r += nm / nr if nr > 0 else eps
        eff += nh > 0 and nr > 0
    if eff == 0:
        return 0.0
    p, r = p / eff, r / eff
    f = beta * beta
    return 100 * (1 + f) * p * r / (f * p + r) if p + r else 0.0


ROWS = [("the cat sat on the mat", "the cat is on the mat"),
        ("a b c d e f", "a b c d e f"),
        ("", "some reference words"),
        ("there is a cat here on it", "the cat is here")]


def test_bleu_matches_brute_force(spark):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(ROWS)], "k long, hyp string, ref string")
    d = df.select("k", words("hyp").alias("h"), words("ref").alias("r"))
    got = M.corpus_bleu(d, "k", "h", "r").first().bleu
    ref = bleu_ref([h.split() for h, _ in ROWS], [r.split() for _, r in ROWS])
    assert abs(got - ref) < 1e-9


def test_bleu_zero_when_order_missing(spark):
    df = spark.createDataFrame([(0, "a b", "a b")], "k long, hyp string, ref string")
    d = df.select("k", words("hyp").alias("h"), words("ref").alias("r"))
    assert M.corpus_bleu(d, "k", "h", "r").first().bleu == 0.0


def test_chrf_matches_brute_force(spark):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(ROWS)], "k long, hyp string, ref string")
    got = M.corpus_chrf(df, "k", "hyp", "ref").first().chrf
    assert abs(got - chrf_ref([h for h, _ in ROWS], [r for _, r in ROWS])) < 1e-9


def test_tokenizers(spark):
    df = spark.createDataFrame([("Hello, world. 3.5-4 &amp; (x)", "我们 say 你好!")], "a string, b string")
    r = df.select(M.tok_13a("a").alias("a"), M.tok_zh("b").alias("b")).first()
    assert r.a == ["Hello", ",", "world", ".", "3.5", "-", "4", "&", "(", "x", ")"]
    assert r.b == ["我", "们", "say", "你", "好", "!"]


def test_eval_summary_per_direction_and_pooled_chrf(spark):
    rows = [(0, "zh2en", "s", "the cat sat", "the cat sat", 3), (1, "en2zh", "s", "我们你好", "我们好", 4)]
    recs = spark.createDataFrame(rows, "ex_id long, direction string, src string, hyp string, ref string, gen_tok int")
    s = {r.direction: r for r in M.eval_summary(recs).collect()}
    assert set(s) == {"zh2en", "en2zh", "__all__"}
    assert s["__all__"].bleu is None and s["zh2en"].samples == 1
    assert abs(s["__all__"].chrf - chrf_ref(["the cat sat", "我们你好"], ["the cat sat", "我们好"])) < 1e-9
    ana = {r.direction: r for r in M.output_analysis(recs).collect()}
    assert ana["zh2en"].median_tok == 3.0


def test_checkpoint_curve_and_compare(spark):
    sc = spark.createDataFrame([(1000, "a", 1.0), (2000, "a", 3.0), (3000, "a", 3.0)],
                               "checkpoint int, direction string, bleu double")
    r = M.checkpoint_curve(sc).first()
    assert (r.best_checkpoint, r.best_bleu) == (2000, 3.0)
    sy = spark.createDataFrame([("base", "a", 1.0, 2.0), ("new", "a", 1.5, 1.0)],
                               "system string, direction string, bleu double, chrf double")
    c = {x.system: x for x in M.compare_systems(sy, "base").collect()}
    assert c["new"].delta_bleu == 0.5 and c["new"].delta_chrf == -1.0 and c["base"].delta_bleu == 0.0


def test_model_score_null_without_scorer(spark):
    recs = spark.createDataFrame([("s", "h", "r")], "src string, hyp string, ref string")
    assert M.corpus_model_score(recs, None).first().score is None


def test_pairs_jsonl_roundtrip_and_failfast(spark, tmp_out):
    df = spark.createDataFrame([("你好", "hi", "zh2en")], "src string, tgt string, direction string")
    IO.write_pairs(df, tmp_out + "/p")
    back = IO.read_pairs(spark, tmp_out + "/p").collect()
    assert [tuple(r) for r in back] == [("你好", "hi", "zh2en")]
    raw = os.path.join(tmp_out, "raw.jsonl")
    with open(raw, "w", encoding="utf-8") as f:
        f.write('{"src": "a", "tgt": "b", "direction": "en2zh"}\n\n{"src": "c", "tgt": "d", "direction": "zh2en"}\n')
    assert IO.read_pairs(spark, raw).count() == 2
    bad = os.path.join(tmp_out, "bad.jsonl")
    with open(bad, "w", encoding="utf-8") as f:
        f.write('{"src": "a", "tgt": "b"\n')
    with pytest.raises(Exception):
        IO.read_pairs(spark, bad).collect()
    rows = IO.read_pairs(spark, bad, mode="PERMISSIVE").collect()
    assert [r._corrupt_record is not None for r in rows] == [True]


def test_vocab_map_json_roundtrip(spark, tmp_out):
    vm = spark.createDataFrame([(10, 0), (3, 1)], "old_id int, new_id int")
    IO.write_vocab_map(vm, tmp_out + "/vm", tmp_out + "/vm_json")
    files = [f for f in os.listdir(tmp_out + "/vm_json") if f.startswith("part-")]
    obj = json.loads(open(os.path.join(tmp_out, "vm_json", files[0]), encoding="utf-8").read())
    assert obj == {"10": 0, "3": 1}
    back = {(r.old_id, r.new_id) for r in IO.read_vocab_map(spark, tmp_out + "/vm_json").collect()}
    assert back == {(10, 0), (3, 1)}


def test_eval_jsonl_skips_summary_rows(spark, tmp_out):
    p = os.path.join(tmp_out, "eval.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"direction": "zh2en", "src": "s", "hyp": "h", "ref": "r", "gen_tok": 1}\n\n')
        f.write('{"summary": null}\n{"summary": {"x": 1}}\n')
    recs = IO.read_eval_jsonl(spark, p).collect()
    assert len(recs) == 1 and recs[0].hyp == "h"


def test_segments_text_io(spark, tmp_out):
    p = os.path.join(tmp_out, "seg.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("  first line \n\n   \nsecond\n")
    assert [r.segment for r in IO.read_segments(spark, p).collect()] == ["first line", "second"]
    seg = spark.createDataFrame([("en", "a b"), ("fr", "c")], "lang string, segment string")
    IO.write_segments(seg, tmp_out + "/out")
    listing = os.listdir(tmp_out + "/out")
    assert "lang=en" in listing and "lang=fr" in listing


def test_segments_by_language_and_repeated_eval_records(spark, tmp_out):
    rows = [("en", "a b"), ("en", "a b"), ("zh", "一"), ("7", "number")]
    IO.write_segments(spark.createDataFrame(rows, "lang string, segment string"), tmp_out + "/seg")
    assert sorted((r.lang, r.segment) for r in IO.read_segments(spark, tmp_out + "/seg", by="lang").collect()) == sorted(rows)
    recs = spark.createDataFrame([("en2zh", "s", "h", "r", 1)] * 3, IO.EVAL_SCHEMA)
    IO.write_eval_jsonl(recs, recs.groupBy().count(), tmp_out + "/eval")
    got = IO.read_eval_jsonl(spark, tmp_out + "/eval").collect()
    assert len(got) == 3 and len({r.ex_id for r in got}) == 3


def test_bleu_without_any_match_is_zero(spark):
    from parley.operators import metrics as M
    df = spark.createDataFrame([(1, ["a", "b", "c", "d", "e"], ["v", "w", "x", "y", "z"])], "k int, h array<string>, r array<string>")
    assert M.corpus_bleu(df, "k", "h", "r").first().bleu == 0.0


def test_batch_counts_against_counters():
    import random
    from collections import Counter
    from parley.operators.metrics import batch_counts
    rnd = random.Random(6)
    hyps = [[rnd.choice("abc") for _ in range(rnd.randint(0, 12))] for _ in range(40)] + ["banana", ""]
    refs = [[rnd.choice("abc") for _ in range(rnd.randint(0, 12))] for _ in range(40)] + ["bandana", "x"]
    got = batch_counts(hyps, refs, [1, 2, 4])
    for h, r, row in zip(hyps, refs, got):
        want = []
        for n in (1, 2, 4):
            a, b = (Counter(tuple(x[i:i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
            want += [sum((a & b).values()), sum(a.values()), sum(b.values())]
        assert list(row) == want


def test_tokens_joined_by_spaces_give_the_rules_in_their_first_order(spark):
    import itertools
    import re

    def rules(t):
        for pat, rep in [(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                         (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")]:
            t = re.sub(pat, rep, t)
        return t.split()

    texts = ["".join(x) for x in itertools.product("a3.-& 中\u3000", repeat=4)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", M.tok_zh("t").alias("zh"), M.tok_13a("t").alias("en")).collect():
        assert r.zh == rules(re.sub(M.ZH_CLASS, r" \g<0> ", r.t.strip(" "))), r.t
        assert r.en == rules(" " + r.t + " "), r.t


def test_scores_of_groups_equal_the_exploded_form(spark):
    rows = [(i, "zh2en" if i % 2 else "en2zh", f"the cat {i} sat, on it", f"the cat {i} sat on  it.") for i in range(9)]
    recs = spark.createDataFrame(rows, "ex_id long, direction string, hyp string, ref string")
    got = {r.direction: r for r in M.corpus_scores(recs, ["direction"]).collect()}
    toks = recs.select("*", M.bleu_tokens("hyp", "direction").alias("h"), M.bleu_tokens("ref", "direction").alias("r"))
    for r in M.corpus_bleu(toks, "ex_id", "h", "r", ["direction"], method="explode").collect():
        assert abs(got[r.direction].bleu - r.bleu) < 1e-9
    for r in M.corpus_chrf(recs, "ex_id", "hyp", "ref", ["direction"], method="explode").collect():
        assert abs(got[r.direction].chrf - r.chrf) < 1e-9
