"""The stable-prefix stream equals the batch form in any order of arrival, and its state ends."""
import json
import os

from pyspark.sql import functions as F

from parley.functions.tokenize import CODEPOINT
from parley.operators import profile as P
from parley.streaming import continuous as SC
from parley.streaming import revisions as RV

N, K = 2, 2


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps({"session": s, "ts": f"2024-01-01T00:{m:02d}:{sec:02d}.000Z", "text": t}) + "\n" for s, m, sec, t in rows)
    os.utime(os.path.join(folder, name), (1.7e9 + int(name[0]),) * 2)  # files are read by time


def _run(spark, src, tmp_out):
    stream = spark.readStream.schema("session string, ts timestamp, text string").option("maxFilesPerTrigger", 1).json(src)
    q = (RV.stable_stream(stream, N, K, watermark="5 minutes", idle_ms=60_000).writeStream.outputMode("append")
         .option("checkpointLocation", tmp_out + "/ck").trigger(availableNow=True).format("parquet").start(tmp_out + "/out"))
    q.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    return spark.read.parquet(tmp_out + "/out"), states


def test_stream_equals_batch_over_micro_batches_and_disorder(spark, tmp_out):
    text = "one two three four five six seven eight"
    rows = [(s, 0, i, " ".join(text.split()[:i + 1]) + ("" if i % 3 else " ~")) for s in ("a", "b") for i in range(8)] + [("c", 0, 4, None)]
    src = tmp_out + "/src"
    os.mkdir(src)
    # each file is a micro-batch, rows backwards, later revisions of a session before earlier ones
    _write(src, "1.json", [r for r in reversed(rows) if r[2] % 2])
    _write(src, "2.json", [r for r in reversed(rows) if not r[2] % 2])
    _write(src, "3.json", [("end", 30, 0, "")])
    _write(src, "4.json", [("end", 40, 0, "")])  # the watermark of the batch before decides what is late
    _write(src, "5.json", [("a", 0, 3, "late words that come after the watermark"), ("end", 50, 0, "")])
    batch_size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got, states = _run(spark, src, tmp_out)
        got = sorted(map(tuple, got.filter("session <> 'end'").collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_size)
    df = spark.createDataFrame([(s, f"2024-01-01 00:{m:02d}:{sec:02d}", t or "") for s, m, sec, t in rows], "session string, ts string, text string")
    batch = RV.trigger_points(RV.stable_prefix(df.withColumn("ts", F.to_timestamp("ts")), N), K)
    want = sorted(map(tuple, batch.select("session", "ts", "stable_len", "emitted", "fire").collect()))
    assert got == want
    assert max(states) >= 3 and states[-1] <= 1  # only the closing session is left


def test_continuous_profile_equals_batch_after_several_versions(spark, tmp_out):
    rows = [("one two", "一二三四", "en2zh"), ("", "  ", "en2zh"), ("三", "three", "zh2en"), ("same", "same", "zh2en"), (None, "x", None)]
    df = spark.createDataFrame(rows, "src string, tgt string, direction string")
    df.repartition(3).write.json(tmp_out + "/src")
    SC.run_continuous(spark, tmp_out + "/src", tmp_out + "/out", tmp_out + "/ck", CODEPOINT, only=["profile"], max_files_per_trigger=1)
    assert sorted(os.listdir(tmp_out + "/out")) == ["profile"] and len(os.listdir(tmp_out + "/out/profile")) >= 2
    got = SC.with_rates(SC.latest(spark, tmp_out + "/out/profile"))
    want = P.quality_profile(df).filter("direction <> '__all__'").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_latest_of_no_rows(spark, tmp_out):
    spark.createDataFrame([], "direction string, n long").write.parquet(tmp_out + "/t/kind=delta/version=0")
    assert SC.latest(spark, tmp_out + "/t", ["direction"]).count() == 0


def _delta(spark, lo, hi, v):
    return spark.range(lo, hi).select(F.when(F.col("id") > 0, F.col("id")).alias("token_id"), F.lit(v).cast("long").alias("freq"))


def test_deltas_follow_the_changed_keys(spark, tmp_out):
    path = tmp_out + "/token_freq"
    write = SC._delta_sink(path, ["token_id"], 50)
    want = {}
    for i, (lo, hi) in enumerate([(0, 1000), (0, 10), (5, 20), (990, 1005), (0, 1)]):  # key 0 stands as null
        write(_delta(spark, lo, hi, i), i)
        want |= {k or None: i for k in range(lo, hi)}
        assert dict(map(tuple, SC.latest(spark, path).collect())) == want
    written = {tuple(r)[:2]: r["count"] for r in spark.read.parquet(path).groupBy("kind", "version").count().collect()}
    assert written == {("delta", 0): 1000, ("base", 0): 1000, ("delta", 1): 10, ("delta", 2): 15, ("delta", 3): 15, ("delta", 4): 1}
    write(_delta(spark, 0, 1, 4), 4)  # a replay
    assert dict(map(tuple, SC.latest(spark, path).collect())) == want
    write(_delta(spark, 0, 1200, 5), 5)
    write(_delta(spark, 3, 4, 6), 6)
    assert SC.drop_old(spark, path) == 1  # the first delta, which the first base holds
    assert dict(map(tuple, SC.latest(spark, path).collect())) == {k or None: 6 if k == 3 else 5 for k in range(1200)}


def test_few_deltas_between_bases(spark, tmp_out):
    path = tmp_out + "/token_freq"
    write = SC._delta_sink(path, ["token_id"], 3)
    for i in range(7):
        write(_delta(spark, 1, 100 if i == 0 else 2, i), i)
    bases = spark.read.parquet(path).filter("kind = 'base'").select("version").distinct().collect()
    assert sorted(r[0] for r in bases) == [0, 3, 6]
    assert SC.latest(spark, path).filter("freq = 6").count() == 1 and SC.latest(spark, path).count() == 99
