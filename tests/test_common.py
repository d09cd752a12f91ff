"""Plan-shape helpers: salted per-group top-n, distributed global index, checked broadcast."""
import random

import pytest
from pyspark.sql import functions as F

from parley.operators.common import broadcast_if_small, global_index, top_n_per_group


@pytest.fixture
def skewed(spark):
    random.seed(3)
    # one hot group holding most rows, plus small groups
    rows = [("hot", i, random.random()) for i in range(3000)] + [(f"g{i % 7}", i, random.random()) for i in range(300)]
    return spark.createDataFrame(rows, "g string, id int, v double").repartition(9)


@pytest.mark.parametrize("salt", [None, 0, 1, 16, 40, 300])
def test_top_n_per_group_matches_python(skewed, salt):
    got = {(r.g, r.id) for r in top_n_per_group(skewed, ["g"], [F.col("v").desc(), "id"], 5, salt_buckets=salt).collect()}
    rows = skewed.collect()
    want = set()
    for g in {r.g for r in rows}:
        top = sorted((r for r in rows if r.g == g), key=lambda r: (-r.v, r.id))[:5]
        want |= {(r.g, r.id) for r in top}
    assert got == want


def test_top_n_salted_levels_shrink_by_fan_in(skewed):
    plan = top_n_per_group(skewed, ["g"], ["id"], 3, salt_buckets=300)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # 300, 19 and 2 buckets, then the group


def test_top_n_plan_has_group_limit(skewed):
    plan = top_n_per_group(skewed, ["g"], ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(13)
    idx = global_index(df, ["k"], name="i", partitions=7)
    rows = sorted((r.i, r.k) for r in idx.collect())
    assert [i for i, _ in rows] == list(range(1000))
    assert [k for _, k in rows] == sorted(k for _, k in rows)


def test_global_index_running_sum_and_total(spark):
    df = spark.createDataFrame([(i, float(i % 5) - 2.0) for i in range(200)], "k int, x double").repartition(5)
    idx = global_index(df, ["k"], name="i", partitions=6, running_sum="x", running_name="cum", total_name="tot")
    rows = sorted((r.k, r.cum, r.tot) for r in idx.collect())
    acc = 0.0
    for k, cum, tot in rows:
        acc += float(k % 5) - 2.0
        assert abs(cum - acc) < 1e-9
        assert abs(tot - sum(float(j % 5) - 2.0 for j in range(200))) < 1e-9


def test_broadcast_if_small_checks_size(spark):
    small = spark.range(5)
    big = spark.range(50)
    j_small = spark.range(100).join(broadcast_if_small(small, 10), "id")
    j_big = spark.range(100).join(broadcast_if_small(big, 10), "id")
    assert "ResolvedHint" in j_small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in j_big._jdf.queryExecution().analyzed().toString()
    assert j_small.count() == 5 and j_big.count() == 50


def test_broadcast_if_small_checks_bytes(spark):
    wide = spark.range(5).select("id", F.repeat(F.lit("x"), 1000).alias("s"), F.array("id").alias("a"))
    hinted = lambda b: "ResolvedHint" in spark.range(9).join(
        broadcast_if_small(wide, 10, b), "id")._jdf.queryExecution().analyzed().toString()
    assert hinted(10_000) and not hinted(4_000)
