"""Sessions that share a state row give the rows they give alone, and calls do not grow with the sessions."""
import json
import os

from parley.streaming import revisions as RV


def _write(folder, i, rows):
    path = os.path.join(folder, f"{i}.json")
    with open(path, "w") as f:
        f.writelines(json.dumps({"session": s, "ts": f"2024-01-01T00:{m:02d}:{sec:02d}.000Z", "text": t}) + "\n" for s, m, sec, t in rows)
    os.utime(path, (1.7e9 + i,) * 2)  # files are read by time


def _run(spark, src, out, buckets):
    stream = spark.readStream.schema("session string, ts timestamp, text string").option("maxFilesPerTrigger", 1).json(src)
    q = (RV.stable_stream(stream, 2, 2, watermark="2 minutes", idle_ms=60_000, buckets=buckets).writeStream.outputMode("append")
         .option("checkpointLocation", out + "/ck").trigger(availableNow=True).format("parquet").start(out + "/out"))
    q.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    return sorted(map(repr, map(tuple, spark.read.parquet(out + "/out").collect()))), states


def test_bucketed_sessions_equal_sessions_alone(spark, tmp_out):
    text = "one two three four five six".split()
    names = [None, ""] + [f"s{i}" for i in range(40)]
    rows = [(s, i % 3, r, " ".join(text[:r + 1]) + (" ~" if (i + r) % 3 else "")) for i, s in enumerate(names) for r in range(6)]
    src = tmp_out + "/src"
    os.mkdir(src)
    _write(src, 1, [r for r in reversed(rows) if r[2] % 2])
    _write(src, 2, [r for r in reversed(rows) if not r[2] % 2])
    _write(src, 3, [("s1", 4, 1, "one two"), ("s2", 3, 30, "one two three four five six")])
    _write(src, 4, [("tick", 9, 0, "")])   # the first sessions are over in the next batch, s1 and s2 too
    _write(src, 5, [("tick", 12, 0, ""), ("s1", 11, 1, "one two"), ("s1", 11, 2, "one two")])
    _write(src, 6, [("tick", 30, 0, "")])
    alone, many = _run(spark, src, tmp_out + "/alone", 1 << 30)
    shared, few = _run(spark, src, tmp_out + "/shared", 2)
    assert shared == alone and len(alone) >= len(rows) + 4
    assert max(many) > 40 and max(few) <= 2 and few[-1] <= 1


def test_calls_are_bounded_by_default(spark, tmp_out):
    src = tmp_out + "/src"
    os.mkdir(src)
    _write(src, 1, [(f"s{i}", 0, 0, "a b") for i in range(3 * RV.BUCKETS)])
    _write(src, 2, [("tick", 30, 0, "")])
    stream = spark.readStream.schema("session string, ts timestamp, text string").option("maxFilesPerTrigger", 1).json(src)
    q = (RV.stable_stream(stream, 2, 2).writeStream.outputMode("append").option("checkpointLocation", tmp_out + "/ck")
         .trigger(availableNow=True).format("parquet").start(tmp_out + "/out"))
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= RV.BUCKETS
    assert spark.read.parquet(tmp_out + "/out").filter("stable_len = 2").count() == 3 * RV.BUCKETS
