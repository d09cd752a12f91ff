"""BLEU's tokenizers on code points, n-gram counts from one sort, and both scores from one function."""
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parley.functions import mteval as T
from parley.operators import metrics as M

RULES = [(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "), (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")]


def by_rules(t, zh):
    if zh:
        t = re.sub(M.ZH_CLASS, r" \g<0> ", t.strip(" "))
    else:
        for old, new in T.REPLACED:
            t = t.replace(old, new)
        t = f" {t} "
    for pat, rep in RULES:
        t = re.sub(pat, rep, t)
    return t.split()


def in_lists(numbers, sizes):
    return np.split(numbers, np.cumsum(sizes)[:-1])


@pytest.mark.parametrize("zh", [False, True])
def test_cut_places_equal_the_regular_expressions(zh):
    texts = ["".join(x) for k in range(6) for x in itertools.product("a3.-& 中　", repeat=k) if k < 5 or x[0] != x[2]]
    texts += ["a&amp;lt;b", "-\nx<skipped>y\nz&quot;q", "-<skipped>\nx", "5..6", "a...5,,5,.x", "3.14,15.,", " .5 ", "a'b_c d-e 5-6 5--6", "😀.5é,é"]
    (tokens, counts), (chars, lengths) = T.side_units(pa.array(texts), zh)
    name = {}
    for t, numbers, ink in zip(texts, in_lists(tokens, counts), in_lists(chars, lengths), strict=True):
        want = by_rules(t, zh)
        assert len(numbers) == len(want), t
        assert all(name.setdefault(i, w) == w for i, w in zip(numbers, want, strict=True)), t
        assert len(ink) == len(re.sub(r"[\s\x1c-\x1f]", "", t)), t
    assert len(set(name.values())) == len(name) == tokens.max() + 1


def test_units_of_nulls_and_nothing():
    (tokens, counts), (chars, lengths) = T.side_units(pa.array([None, "", " ", "ab c", None]).slice(1), False)
    assert tokens.tolist() == [0, 1] or tokens.tolist() == [1, 0]
    assert counts.tolist() == [0, 0, 2, 0] and lengths.tolist() == [0, 0, 3, 0] and len(set(chars.tolist())) == 3
    assert [len(x) for side in T.side_units(pa.array([], pa.string()), True) for x in side] == [0] * 4


@pytest.mark.parametrize("alphabet", [5, 200, 3000, 60000])
def test_counts_where_units_do_and_do_not_fit_a_number(alphabet):
    rnd = random.Random(alphabet)
    pick = lambda n: [rnd.randrange(alphabet) for _ in range(n)]
    refs = [pick(rnd.randint(0, 60)) for _ in range(300)] + [pick(3000), [1] * 50]
    hyps = [r[:rnd.randint(0, 50)] + pick(rnd.randint(0, 9)) for r in refs]
    sizes = np.array([len(x) for x in hyps + refs])
    for orders in ([1, 2, 4], range(1, 7), [3], [1], range(1, 10)):
        got = M._counted(np.array([u for x in hyps + refs for u in x]), sizes, orders)
        for h, r, row in zip(hyps, refs, got, strict=True):
            want = []
            for n in orders:
                a, b = (Counter(tuple(x[i:i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
                want += [sum((a & b).values()), sum(a.values()), sum(b.values())]
            assert row.tolist() == want


def test_both_scores_come_from_one_function_without_regular_expressions(spark):
    """The rules' regular expressions were most of the time of evaluation summaries, rescoring, checkpoint curves and system comparisons."""
    rows = [("en2zh", "我有 a.b,5", "我有他 a.b, 5"), ("zh2en", "It's 3.14 -- x-5-6.", "It's 3.14 - x 5-6."), ("zh2en", None, "x"), (None, "a b", "a  b")] * 3
    recs = spark.createDataFrame(rows, "direction string, hyp string, ref string")
    counted = M.both_rows(recs, ["direction"], "direction", "hyp", "ref")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("EvalPython") == 1
    for r, (direction, hyp, ref) in zip(counted.collect(), rows, strict=True):
        zh = (direction or "").endswith("2zh")
        no_space = [re.sub(r"\s", "", x or "") for x in (hyp, ref)]
        want = [M.batch_counts(*[[x] for x in pair], orders)[0].tolist() for pair, orders in (
            ([by_rules(x or "", zh) for x in (hyp, ref)], range(1, 5)), (no_space, range(1, 7)))]
        assert list(r["_s"]) == want[0] + want[1]


def test_utf8_bytes_are_counted_by_batch(spark):
    """A row for each byte, made from hexadecimal text, was most of the byte statistics' time."""
    from parley.functions.tokenize import UTF8, utf8_bytes
    from parley.operators import vocab as V
    df = spark.createDataFrame([("aé中😀",), (None,), ("",), ("aa",)], "text string")
    freq = V.token_freq(df, UTF8)
    want = Counter("aé中😀aa".encode())
    assert {tuple(r) for r in freq.collect()} == set(want.items())
    assert {tuple(r) for r in df.select(M.F.explode(UTF8.encode(M.F.col("text"))).alias("b")).groupBy("b").count().collect()} == set(want.items())
    assert "Generate" not in freq._jdf.queryExecution().optimizedPlan().toString()
    broken = pa.Array.from_buffers(pa.string(), 2, [None, pa.py_buffer(np.array([0, 2, 4], np.int32)), pa.py_buffer(b"a\xffbc")])
    for texts, ids, sizes in ((pa.array(["skip", "é", None, "b"]).slice(1), [0xc3, 0xa9, 98], [2, 0, 1]), (broken, [97, 0xef, 0xbf, 0xbd, 98, 99], [4, 2]),
                              (pa.array([], pa.string()), [], []), (pa.array(["é"]), [0xc3, 0xa9], [2])):
        got = utf8_bytes(texts)
        assert got[0].tolist() == ids and got[1].tolist() == sizes
    for ids in ([], [3], [0, 0, 1], [7, 1 << 20, 7]):
        got = V.counted_ids(np.array(ids, np.int32))
        assert dict(zip(*(x.tolist() for x in got), strict=True)) == Counter(ids)
