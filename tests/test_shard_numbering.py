"""What the sharded queries share: rows computed once, texts numbered, records made in their shards."""
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from parley.operators import corpus as C
from parley.operators import shards as SH
from parley.sources import shardstore as SS


def _counted(spark, n):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        seen.add(1)
        return f"text {i}"
    return spark.range(n, numPartitions=3).select((F.col("id") * 7 % n).alias("row_id"), text("id").alias("text")), seen


def test_rows_are_computed_once_for_the_numbering(spark):
    df, seen = _counted(spark, 1000)
    out = SH.assign_shards(df, ["row_id"], 64)
    assert [tuple(r) for r in out.orderBy("row_id").select("row_id", "global_idx", "shard_id", "local_idx").collect()] == \
        [(i, i, i // 64, i % 64) for i in range(1000)]
    assert seen.value == 1000
    assert not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(df._jdf).isDefined()


def test_records_are_made_in_the_shards_and_lie_in_order(spark, tmp_out):
    df = spark.range(1000, numPartitions=3).select((F.col("id") * 7 % 1000).alias("row_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    forms = []

    def form(s):
        forms.append(s.columns)
        return s.select("row_id", "global_idx", "local_idx", "shard_id", F.split("text", "").alias("chars"))
    plain = [tuple(r) for r in SH.assign_shards(df, ["row_id"], 300).select("row_id", "global_idx", "local_idx", "shard_id", F.split("text", "")).orderBy("row_id").collect()]
    man = SH.write_shards(df, tmp_out + "/s", ["row_id"], 300, form)
    got = spark.read.parquet(tmp_out + "/s").select("row_id", "global_idx", "local_idx", "shard_id", "chars")
    assert [tuple(r) for r in got.orderBy("row_id").collect()] == plain
    assert sorted(map(tuple, man.collect())) == [(0, 300, 0, 300), (1, 300, 300, 600), (2, 300, 600, 900), (3, 100, 900, 1000)]
    files = [f for f in got.inputFiles()]
    assert len(files) == 4
    for f in files:
        ids = pq.read_table(f.replace("file:", ""), columns=["local_idx"], partitioning=None).column("local_idx").to_pylist()
        assert ids == list(range(len(ids)))
    committed = SS.write_committed(df, tmp_out + "/c", ["row_id"], 300, form)
    assert sorted(map(tuple, committed.select("shard_id", "n", "start", "end").collect())) == sorted(map(tuple, man.collect()))
    back = spark.read.format(SS.FORMAT).load(tmp_out + "/c").select("row_id", "global_idx", "local_idx", "shard_id", "chars")
    assert [tuple(r) for r in back.orderBy("row_id").collect()] == plain
    assert all("chars" not in c for c in forms) and len(forms) == 2


def test_a_pair_is_cleaned_once(spark):
    df = spark.createDataFrame([(1, " a  b　", "x", "k"), (2, None, "x", "l"), (3, "a" * 9, "b", "m"), (4, "y\t", " z z", "n")], "id int, src string, tgt string, k string")
    out = C.filter_pairs(df, max_ratio=4.0)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "a b", "x", "k"), (4, "y", "z z", "n")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 2
