"""Row-local mapping: against plain Python, beyond the broadcast bound, with repeated and null keys, without a shuffle, on streams."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parley.functions.tokenize import CODEPOINT, decode_ids
from parley.operators import lookup as L
from parley.operators import scores as SC
from parley.operators import sequences as S
from parley.streaming.rowwise import through_stream

SCHEMA = "k long, ids array<int>, labels array<int>, vals array<double>"
TABLE = {i: 1000 - i for i in range(0, 60, 2)}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    out = []
    for i in range(300):
        ids = [r.choice([None, r.randint(-3, 70), r.randint(0, 29) * 2]) for _ in range(r.choice([0, 1, 3, 40]))]
        out.append((r.choice([None, 1, i]), ids, [-100 if r.random() < 0.3 else x for x in ids], [r.uniform(-4, 4) for _ in ids]))
    return out + [(7, None, None, None), (7, [], [], [])]


@pytest.fixture(scope="module")
def vmap(spark):
    return spark.createDataFrame([(o, n) for o, n in TABLE.items()] + [(4, 5000), (None, 1), (6, None)], "old_id int, new_id int")


@pytest.fixture(params=["broadcast", "join"])
def bound(request, monkeypatch):
    if request.param == "join":
        monkeypatch.setattr(L, "MAX_MAP_ROWS", 3)
    return request.param


def collected(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_remap_keeps_rows_of_equal_and_null_keys_apart(spark, rows, vmap, bound):
    df = spark.createDataFrame(rows, SCHEMA)
    for unk in (None, 3):
        want = [(k, [TABLE.get(x, unk) for x in ids or [] if x in TABLE or unk is not None and x is not None]) for k, ids, _, _ in rows]
        assert collected(S.remap_ids(df, "ids", vmap, "k", unk), "k", "ids") == sorted(want, key=repr)
        assert collected(S.remap_ids_arrow(df, "ids", vmap, unk, "out"), "k", "out") == sorted(want, key=repr)
    there = S.remap_ids(df, "ids", vmap, "k")
    back = S.remap_ids(there, "ids", vmap.filter("new_id <> 5000"), "k", inverse=True)
    assert collected(back, "k", "ids") == sorted([(k, [x for x in ids or [] if x in TABLE]) for k, ids, _, _ in rows], key=repr)
    with pytest.raises(Exception, match="unknown new id"):
        S.remap_ids(spark.createDataFrame([(1, [5])], "k long, ids array<int>"), "ids", vmap, "k", inverse=True).collect()


def test_export_and_topk_against_plain_python(spark, rows, vmap, bound):
    df = spark.createDataFrame(rows, SCHEMA)
    want = [(k, *[[-100 if x == -100 else TABLE.get(x, 9) for x in c or []] for c in (ids, labels)]) for k, ids, labels, _ in rows]
    assert collected(S.export_remap(df, vmap, 9, "k", "ids", "labels"), "k", "ids", "labels") == sorted(want, key=repr)
    top = SC.remap_topk(df, ["k"], "ids", "vals", vmap, 3 if bound == "join" else None)
    want = [(k, [j for j, x in enumerate(ids or []) if x in TABLE], [TABLE[x] for x in ids or [] if x in TABLE]) for k, ids, _, _ in rows]
    assert collected(top, "k", "keep_pos", "new_ids") == sorted(want, key=repr)
    assert all(abs(sum(map(__import__("math").exp, r.logp)) - 1) < 1e-9 for r in top.collect() if r.logp)


def test_decode_against_plain_python(spark, rows, bound, monkeypatch):
    if bound == "join":
        monkeypatch.setattr("parley.functions.tokenize.MAX_PIECES", 3)
    pieces = spark.createDataFrame([(i, chr(97 + i % 26)) for i in range(40)], "token_id int, piece string")
    got = collected(decode_ids(spark.createDataFrame(rows, SCHEMA), "ids", pieces, "k", "-"), "k", "text")
    want = [(k, "-".join(chr(97 + x % 26) if x is not None and 0 <= x < 40 else "" for x in ids or [])) for k, ids, _, _ in rows]
    assert got == sorted(want, key=repr)


def test_plans_have_no_exchange(spark, rows, vmap):
    df = spark.createDataFrame(rows, SCHEMA)
    for out in (S.remap_ids(df, "ids", vmap, "k"), S.export_remap(df, vmap, 9, "k", "ids", "labels"), SC.remap_topk(df, ["k"], "ids", "vals", vmap),
                S.build_examples(df.select("k", F.lit("a").alias("src"), F.lit("b").alias("tgt"), F.lit("zh2en").alias("direction")), vmap, CODEPOINT, 1, key="k")):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_streams_equal_batch(spark, rows, vmap):
    """Each form over several micro-batches, repeated and null keys among them."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pairs = df.select("k", F.concat_ws("", F.transform("ids", lambda x: F.char(65 + F.abs(x) % 26))).alias("src"), F.lit("ab一").alias("tgt"), F.lit("en2zh").alias("direction"))
    letters = spark.createDataFrame([(i, i % 50) for i in range(10, 120)], "old_id int, new_id int")
    forms = {"remap": (df, lambda x: S.remap_ids(x, "ids", vmap, "k", 3)), "arrow": (df, lambda x: S.remap_ids_arrow(x, "ids", vmap)),
             "export": (df, lambda x: S.export_remap(x, vmap, 9, "k", "ids", "labels")), "topk": (df, lambda x: SC.remap_topk(x, ["k"], "ids", "vals", vmap)),
             "examples": (pairs, lambda x: S.build_examples(x, letters, CODEPOINT, 1, key="k"))}
    for name, (source, form) in forms.items():
        got, batches = through_stream(source, form, name, files_per_batch=2)
        assert collected(got, *got.columns) == collected(form(source), *got.columns), name
        assert batches >= 2, name


def test_a_stream_beyond_the_bound_raises(spark, rows, vmap, monkeypatch):
    monkeypatch.setattr(L, "MAX_MAP_ROWS", 3)
    with pytest.raises(ValueError, match="within the broadcast bound"):
        through_stream(spark.createDataFrame(rows, SCHEMA), lambda x: S.remap_ids(x, "ids", vmap, "k"), "beyond")


def test_empty_tables(spark, vmap):
    df = spark.createDataFrame([], SCHEMA)
    assert S.remap_ids(df, "ids", vmap, "k").collect() == []
    one = spark.createDataFrame([(1, [2, 4], [2], [0.5, 0.1])], SCHEMA)
    none = vmap.filter("false")
    assert S.remap_ids(one, "ids", none, "k").first().ids == [] and S.export_remap(one, none, 8, "k", "ids", "labels").first().ids == [8, 8]


def test_blocks_shuffle_distinct_ids_only(spark, rows, vmap, monkeypatch):
    """Many small blocks give the rows of one lookup, and what goes to the map is each block's distinct ids."""
    want = sorted(map(str, S.remap_ids(spark.createDataFrame(rows, SCHEMA), "ids", vmap, key="k", unk=-1).collect()))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(L, "MAX_MAP_ROWS", 3)
    for block in (1, 64, 1 << 20):
        monkeypatch.setattr(L, "BLOCK_TOKENS", block)
        got = S.remap_ids(df, "ids", vmap, key="k", unk=-1)
        assert sorted(map(str, got.collect())) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "collect_list" not in plan
    assert "Aggregate [__block" in plan and plan.index("Aggregate [__block") < plan.index("Generate explode")  # distinct before the exchange


def test_blocks_of_an_empty_table_and_map(spark, rows, vmap, monkeypatch):
    monkeypatch.setattr(L, "MAX_MAP_ROWS", -1)
    df = spark.createDataFrame(rows, SCHEMA)
    assert S.remap_ids(df.limit(0), "ids", vmap, key="k").count() == 0
    assert {tuple(r.ids) for r in S.remap_ids(df, "ids", vmap.limit(0), key="k").collect()} == {()}
    assert {r.text for r in decode_ids(df, "ids", spark.createDataFrame([], "token_id int, piece string"), "k").collect()} == {""}
