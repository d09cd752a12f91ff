import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parley.operators import latency as L
from parley.operators import trainlog as TL
from parley.operators import vectors as VE


def test_waitk_delays(spark):
    df = spark.createDataFrame([(5, 3, 1), (2, 6, 4), (3, 0, 1)], "s int, t int, k int")
    got = [r.g for r in df.select(L.waitk_delays("s", "t", "k").alias("g")).collect()]
    assert got == [[1, 2, 3], [2, 2, 2, 2, 2, 2], []]


def test_average_lagging(spark):
    df = spark.createDataFrame([([3, 5, 6], 6, 3), ([1, 1, 2], 8, 3), ([], 7, 0), ([2], 5, 4)],
                               "g array<int>, s int, t int")
    got = [r.al for r in df.select(L.average_lagging("g", "s", "t").alias("al")).collect()]
    # (3 + 3 + 2) / 3; no delay reaches 8, so (1 - 5/3 - 10/3) / 3
    assert abs(got[0] - 8 / 3) < 1e-9 and abs(got[1] + 4 / 3) < 1e-9 and got[2] == 0.0 and got[3] is None


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_al_equals_k_for_waitk_when_lengths_equal(spark, k):
    df = spark.createDataFrame([(6, 6, k)], "s int, t int, k int")
    al = df.select(L.average_lagging(L.waitk_delays("s", "t", "k"), "s", "t").alias("a")).first().a
    assert abs(al - min(k, 6)) < 1e-9 or k > 6


def test_waitk_pairs_and_sample_k(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], ["x", "y"], 2)], "id long, su array<string>, tu array<string>, k int")
    rows = L.waitk_pairs(df, "id", "su", "tu", "k", with_text=True).orderBy("i").collect()
    assert [(r.src_prefix_len, r.tgt_prefix_len, r.src_prefix, r.tgt_prefix) for r in rows] == \
        [(2, 1, "a b", "x"), (3, 2, "a b c", "xy")]
    ks = spark.range(200).select(L.sample_k("id", 3).alias("k")).collect()
    assert {r.k for r in ks} <= {1, 3, 5, 7} and len({r.k for r in ks}) == 4


def _log(spark, losses):
    return spark.createDataFrame([("r", i, float(x)) for i, x in enumerate(losses)], "run string, micro long, loss double")


def test_step_losses_drop_incomplete_group(spark):
    st = TL.step_losses(_log(spark, [1, 2, 3, 4, 5]), 2).orderBy("step").collect()
    assert [(r.step, r.loss) for r in st] == [(0, 1.5), (1, 3.5)]


def test_moving_mean_matches_pandas(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=120).round(3)
    steps = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(vals)] +
                                  [("b", i, float(v) * 2) for i, v in enumerate(vals[:30])], "run string, step long, loss double")
    got = {(r.run, r.step): r.avg_loss for r in TL.moving_mean(steps, 50).collect()}
    ref_a = pd.Series(vals).rolling(50, min_periods=1).mean()
    ref_b = pd.Series(vals[:30] * 2).rolling(50, min_periods=1).mean()
    assert all(abs(got[("a", i)] - ref_a[i]) < 1e-9 for i in range(120))
    assert all(abs(got[("b", i)] - ref_b[i]) < 1e-9 for i in range(30))


def test_moving_mean_keeps_nan_in_its_window_and_crosses_chunks(spark):
    vals = [1.0, 1.0, float("nan"), 4.0, 1.0, 1.0, 7.0, 1.0]
    steps = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)], "run string, step long, loss double")
    got = [r.avg_loss for r in TL.moving_mean(steps, 3, chunk=4).orderBy("step").collect()]
    want = pd.Series(vals)
    want = [want[max(0, i - 2):i + 1].mean(skipna=False) for i in range(8)]
    assert np.allclose(got, want, equal_nan=True) and sum(map(math.isnan, got)) == 3


def test_micro_batches_without_a_loss_are_not_numbered(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, None), ("a", 3, float("nan")), ("a", 4, 0.25)], "run string, t int, loss double")
    assert sorted((r.t, r.micro) for r in TL.number_micro(df, "run", ["t"]).collect()) == [(1, 0), (3, 1), (4, 2)]


def test_sample_k_reaches_every_choice(spark):
    ks = list(range(20))
    assert {r.k for r in spark.range(2000).select(L.sample_k("id", 5, ks).alias("k")).collect()} == set(ks)


def test_number_within_groups(spark):
    df = spark.createDataFrame([("a", 5), ("b", 1), ("a", 2), ("a", 9)], "g string, t int")
    got = sorted((r.g, r.t, r.n) for r in TL.number_within(df, "g", ["t"], "n").collect())
    assert got == [("a", 2, 0), ("a", 5, 1), ("a", 9, 2), ("b", 1, 0)]


def test_finite_check_and_head_tail(spark):
    TL.assert_finite(_log(spark, [1.0, 2.0]), ["loss"])
    with pytest.raises(ValueError):
        TL.assert_finite(_log(spark, [1.0, float("nan")]), ["loss"])
    with pytest.raises(ValueError):
        TL.assert_finite(_log(spark, [float("inf")]), ["loss"])
    steps = spark.createDataFrame([("a", i, float(i)) for i in range(6)] + [("b", i, 1.0) for i in range(3)],
                                  "run string, step long, loss double")
    r = {x.run: x for x in TL.head_tail_mean(steps).collect()}
    assert set(r) == {"a"} and r["a"].head_mean == 1.0 and r["a"].tail_mean == 4.0


def test_select_neurons_and_slices(spark):
    a = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "row_id int, vec array<double>")
    b = spark.createDataFrame([(i, [0.0, 1.0]) for i in range(5)], "row_id int, vec array<double>")
    top = [r.row_id for r in VE.select_neurons(a, b, 3).collect()]
    assert top == [2, 3, 4]
    with pytest.raises(ValueError):
        VE.select_neurons(a, b, 6)
    rows = VE.slice_rows(a, spark.createDataFrame([(1,), (3,)], "row_id int"))
    cols = VE.slice_columns(rows, [1, 0]).orderBy("row_id").collect()
    assert [r.vec for r in cols] == [[0.0, 1.0], [0.0, 3.0]]


def test_embedding_select_restore_extend(spark):
    emb = spark.createDataFrame([(i, [float(i)]) for i in range(6)], "row_id int, vec array<double>")
    vm = spark.createDataFrame([(1, 0), (4, 1)], "old_id int, new_id int")
    pr = VE.select_rows_by_map(emb, vm)
    assert sorted((r.row_id, r.old_id, r.vec[0]) for r in pr.collect()) == [(0, 1, 1.0), (1, 4, 4.0)]
    back = VE.restore_rows(pr, emb, vm)
    assert sorted(r.row_id for r in back.collect()) == [1, 4]
    ext = VE.extend_rows(pr, emb, vm, spark.createDataFrame([(5,), (1,)], "token_id int"))
    assert sorted((r.row_id, r.old_id) for r in ext.collect()) == [(0, 1), (1, 4), (2, 5)]


def test_activation_importance(spark):
    acts = spark.createDataFrame([([1.0, -3.0, 0.0],), ([-1.0, 1.0, 0.5],)], "vec array<double>")
    imp = {r.pos: r.importance for r in VE.activation_importance(acts).collect()}
    assert imp == {0: 1.0, 1: 2.0, 2: 0.25}
    assert [r.pos for r in VE.top_importance(VE.activation_importance(acts), 2).collect()] == [1, 0]


def test_importance_ragged_null_and_empty(spark):
    rows = [([1.0, -2.0, None],), ([3.0],), (None,), ([],), ([-5.0, 4.0, None, 7.0],)]
    acts = spark.createDataFrame(rows, "vec array<float>").repartition(3)
    assert {r.pos: r.importance for r in VE.activation_importance(acts).collect()} == {0: 3.0, 1: 3.0, 3: 7.0}
    assert VE.activation_importance(acts.limit(0)).count() == 0


def test_importance_shuffles_one_row_for_each_task(spark):
    acts = spark.range(4000, numPartitions=4).select(F.array([(F.col("id") * j - 900).cast("float") for j in range(8)]).alias("vec"))
    partial = acts.mapInArrow(VE._partial_sums, "sums array<double>, counts array<long>")
    assert partial.count() == 4
    want = acts.select(F.posexplode("vec").alias("pos", "v")).groupBy("pos").agg(F.avg(F.abs("v")).alias("m"))
    got = {r.pos: r.importance for r in VE.activation_importance(acts).collect()}
    assert got == pytest.approx({r.pos: r.m for r in want.collect()})


def test_moving_mean_of_a_window_wider_than_the_chunk(spark):
    steps = spark.createDataFrame([("r", i, float(i * i % 17)) for i in range(40)], "run string, step long, loss double")
    want = {(r.step, r.avg_loss) for r in TL.moving_mean(steps, window=12).collect()}
    assert {(r.step, r.avg_loss) for r in TL.moving_mean(steps, window=12, chunk=5).collect()} == want
    assert dict(want)[39] == pytest.approx(sum(i * i % 17 for i in range(28, 40)) / 12)
