"""The registered shard source: pushdown, quota with early stop, commit protocol, stream offsets."""
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parley.sources import shardstore as S

SCHEMA = "id long, name string, score double"


def folder(path, n=100, shards=5, name="a"):
    os.makedirs(f"{path}/{name}", exist_ok=True)
    for k in range(shards):
        ids = range(k * n // shards, (k + 1) * n // shards)
        table = pa.table({"id": pa.array(ids, pa.int64()), "name": pa.array([None if i % 10 == 0 else f"{name}{i % 3}" for i in ids], pa.string()),
                          "score": pa.array(map(float, ids), pa.float64())})
        pq.write_table(table, f"{path}/{name}/part-{k:05d}.parquet")


def test_read_pushdown_and_limit(spark, tmp_out):
    folder(tmp_out)
    S.register_source(spark)
    df = spark.read.format(S.FORMAT).load(f"{tmp_out}/a")
    assert df.rdd.getNumPartitions() == 5 and df.count() == 100 and df.schema.simpleString() == "struct<id:bigint,name:string,score:double>"
    some = df.filter("name = 'a1' and id >= 40 and score < 90.5")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "a1" not in plan.split("BatchScan")[0]  # only the comparison of doubles is left to Spark
    assert sorted(r.id for r in some.collect()) == [i for i in range(40, 91) if i % 3 == 1 and i % 10]
    assert df.filter("name is null").count() == 10 and df.filter("name in ('a0', 'a2')").count() == sum(i % 3 != 1 and i % 10 != 0 for i in range(100))
    first = spark.read.format(S.FORMAT).option("limit", 2).schema("id long, name string").load(f"{tmp_out}/a").filter("name = 'a0'")
    assert sorted(r.id for r in first.collect()) == [3, 6, 21, 24, 42, 45, 63, 66, 81, 84]


def test_quota_stops_sources_early(spark, tmp_out):
    for name in ("a", "b", "c"):
        folder(tmp_out, 400, 20, name)
    wanted = {"a": 30, "b": 5, "c": 1_000, "none": 7, "z": 0}

    def accept(df):
        return df.filter(F.col("name").isNotNull() & (F.col("id") % 2 == 0)).select("folder", "id")
    rows, status = S.read_until_quota(spark, tmp_out, wanted, accept, ["id"], f"{tmp_out}/waves", SCHEMA)
    got = {f: sorted(r.id for r in rows.filter(F.col("folder") == f).collect()) for f in wanted}
    passing = [i for i in range(400) if i % 2 == 0 and i % 10]
    assert got == {"a": passing[:30], "b": passing[:5], "c": passing, "none": [], "z": []}
    seen = {r.folder: (r.shards, r.shards_read) for r in status.collect()}
    assert seen["b"] == (20, 1) and seen["a"][1] < 10 and seen["c"] == (20, 20) and seen["none"] == (0, 0) and seen["z"] == (0, 0)
    rows, _ = S.read_until_quota(spark, tmp_out, {"none": 3}, accept, ["id"], f"{tmp_out}/waves2", SCHEMA)
    assert rows.count() == 0 and rows.columns == ["folder", "id"]


def test_commit_makes_shards_and_manifest_together(spark, tmp_out):
    path = f"{tmp_out}/out"
    df = spark.range(2_345).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), F.col("id").cast("string"))).alias("name"))
    man = S.write_committed(df, path, ["id"], 500).orderBy("shard_id").collect()
    assert [(r.shard_id, r.n, r.start, r.end) for r in man] == [(k, min(500, 2_345 - 500 * k), 500 * k, min(2_345, 500 * k + 500)) for k in range(5)]
    back = spark.read.format(S.FORMAT).load(path)
    assert sorted(map(tuple, back.select("id", "name").collect())) == sorted(map(tuple, df.collect()))
    assert back.rdd.getNumPartitions() == 5 and back.filter("shard_id <> floor(id / 500)").count() == 0
    before = sorted(os.listdir(path))
    stop = F.udf(lambda x: 1 // (1_700 - x), "long")
    with pytest.raises(Exception, match="ZeroDivision"):
        S.write_committed(df.withColumn("bad", stop("id")).drop("name"), path, ["id"], 500)
    assert sorted(os.listdir(path)) == before
    with pytest.raises(Exception, match="more than one task"):
        df.select((F.col("id") % 2).cast("int").alias("shard_id"), "id").repartition(3, "id").write.format(S.FORMAT).mode("overwrite").save(path)
    assert sorted(os.listdir(path)) == before
    S.write_committed(df.limit(10), path, ["id"], 500)
    assert spark.read.format(S.FORMAT).load(path).count() == 10  # the earlier files are not read any more
    assert S.write_committed(df.limit(0), path, ["id"], 500).count() == 0
    assert spark.read.format(S.FORMAT).schema("id long").load(path).count() == 0


def test_failing_task_leaves_nothing(spark, tmp_out):
    S.register_source(spark)
    bad = F.udf(lambda x: 1 // (900 - x), "long")
    df = spark.range(1_000).select((F.col("id") / 100).cast("int").alias("shard_id"), "id").repartition(4, "shard_id").sortWithinPartitions("shard_id", "id")
    with pytest.raises(Exception, match="ZeroDivision"):
        df.withColumn("x", bad("id")).write.format(S.FORMAT).mode("overwrite").save(f"{tmp_out}/out")
    assert not os.path.exists(f"{tmp_out}/out") or os.listdir(f"{tmp_out}/out") == []


def test_stream_by_shard_names(spark, tmp_out):
    folder(tmp_out, 100, 5)
    S.register_source(spark)

    def run():
        q = (spark.readStream.format(S.FORMAT).schema(SCHEMA).option("maxShards", 2).load(f"{tmp_out}/a").writeStream.format("parquet")
             .option("path", f"{tmp_out}/sink").option("checkpointLocation", f"{tmp_out}/ckpt").trigger(processingTime="0 seconds").start())
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(r.id for r in spark.read.parquet(f"{tmp_out}/sink").collect())
    assert run() == list(range(100))
    os.link(f"{tmp_out}/a/part-00001.parquet", f"{tmp_out}/a/part-00009.parquet")
    assert run() == sorted([*range(100), *range(20, 40)])  # only the new shard
