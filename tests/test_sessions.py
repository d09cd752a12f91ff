"""Session state on the state API: equal to the batch form in any order of arrival, sessions end, late rows are left out."""
from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from parley.streaming import revisions as RV
from parley.streaming import sessions as SS

N, K = 2, 2
SCHEMA = "session string, ts timestamp, text string"


def write(folder, number, rows):
    """rows: (session, milliseconds, text)."""
    path = os.path.join(folder, f"{number}.json")
    with open(path, "w") as f:
        f.writelines(json.dumps({"session": s, "ts": None if ms is None else f"2024-01-01T{ms // 3_600_000:02d}:{ms // 60_000 % 60:02d}:{ms // 1000 % 60:02d}.{ms % 1000:03d}Z",
                                 "text": t}) + "\n" for s, ms, t in rows)
    os.utime(path, (1.7e9 + number,) * 2)


def run(spark, src, form, out):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    with SS.rocksdb_state(spark):
        q = form(stream, N, K, watermark="5 minutes", idle_ms=60_000).writeStream.outputMode("append").option(
            "checkpointLocation", out + "/ck").trigger(availableNow=True).format("parquet").start(out + "/out")
        q.awaitTermination()
    return spark.read.parquet(out + "/out")


def revisions():
    text, r = "one two three four five six seven eight nine ten", random.Random(3)
    rows = []
    for s in ("a", "b", "c d", None):
        for i in range(12):
            words = text.split()[:r.randint(0, 10)]
            rows.append((s, 1000 * i + r.randint(0, 900), " ".join(words) + r.choice(["", " ~", "  x"])))
    return rows + [("tie", 5000, "x y"), ("tie", 5000, "x y z"), ("tie", 5000, "a"), ("nothing", 7000, None)]


def batch(spark, rows):
    df = spark.createDataFrame([(s, ms, t or "") for s, ms, t in rows], "session string, ms long, text string")
    df = df.select("session", F.timestamp_millis(F.lit(1704067200000) + F.col("ms")).alias("ts"), "text")
    return RV.trigger_points(RV.stable_prefix(df, N), K)


@pytest.mark.parametrize("kind", ["revisions", "sessions"])
def test_stream_equals_batch_over_shuffled_micro_batches(spark, tmp_out, kind):
    rows = [x for x in revisions() if x[0] != "tie"]
    shuffled = random.Random(1).sample(rows, len(rows))
    src = tmp_out + "/src"
    os.mkdir(src)
    for i in range(4):
        write(src, i, shuffled[i::4])
    write(src, 5, [("end", 3_600_000, ""), (None, None, "no time")])
    write(src, 6, [("end", 7_200_000, ""), ("a", 2000, "late words after the watermark")])
    write(src, 7, [("end", 9_000_000, "")])
    form = SS.stable_sessions if kind == "revisions" else SS.session_latency
    got = run(spark, src, form, tmp_out).filter("session is null or session <> 'end'")
    want = batch(spark, rows)
    want = want.select(*got.columns) if kind == "revisions" else RV.segment_latency(want).select(*got.columns)
    key = lambda r: repr(tuple(r))
    rounded = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=key)
    assert rounded(got) == rounded(want)


def test_equal_times_go_by_text_and_a_session_starts_again_after_its_end(spark, tmp_out):
    src = tmp_out + "/src"
    os.mkdir(src)
    write(src, 1, [("tie", 5000, "x y z"), ("tie", 5000, "a"), ("tie", 5000, "x y")])
    write(src, 2, [("end", 3_600_000, "")])
    write(src, 3, [("tie", 4_000_000, "again")])
    write(src, 4, [("end", 9_000_000, "")])
    write(src, 5, [("end", 9_900_000, "")])
    got = run(spark, src, SS.stable_sessions, tmp_out).filter("session = 'tie'").orderBy("ts", "stable_len").collect()
    assert sorted(r.stable_len for r in got[:3]) == [0, 1, 2] and (got[3].stable_len, got[3].emitted) == (1, 0)


def test_many_revisions_of_one_session(spark, tmp_out):
    """Each is a row, in order, and a worker holds one millisecond's revisions at a time."""
    src = tmp_out + "/src"
    os.mkdir(src)
    n = 3000
    rows = [("long", 3 * i, " ".join(["w"] * (i % 7))) for i in range(n)]
    write(src, 1, random.Random(2).sample(rows, n))
    write(src, 2, [("end", 3_600_000, "")])
    write(src, 3, [("end", 9_000_000, "")])
    got = run(spark, src, SS.stable_sessions, tmp_out).filter("session = 'long'").orderBy("ts").collect()
    assert [r.stable_len for r in got] == [min(i % 7, (i - 1) % 7) if i else 0 for i in range(n)]


class Store(dict):
    """Stands for the handle and both states of one session, and counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.value = 0, [], None

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return self.Value(self)

    class Value:
        def __init__(self, store):
            self.store = store

        def get(self):
            self.store.calls += 1
            return self.store.value

        def exists(self):
            return self.get() is not None

        def update(self, value):
            self.store.calls += 1
            self.store.value = value

        def clear(self):
            self.update(None)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def containsKey(self, key):
        return self.getValue(key) is not None

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class At:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


@pytest.mark.parametrize("per_session", [False, True])
def test_a_session_needs_one_timer_and_gives_its_rows_together(per_session):
    import pandas as pd
    n, store = 40, Store()
    p = SS.Revisions(N, K, 60_000, per_session)
    p.init(store)
    for part in (range(0, n, 2), range(1, n, 2)):
        list(p.handleInputRows(("s",), iter([pd.DataFrame({"us": [1_000_000 * (i + 1) for i in part], "line": ["a b c"] * len(part)})]), At(0)))
    assert store.timers == [1000]
    out = [f for w in (20_500, 20_700, 1_000_000) for t in sorted(t for t in set(store.timers) if t <= w) for f in p.handleExpiredTimer(("s",), At(w), At(t))]
    assert [len(f) for f in out] == ([1] if per_session else [20, 20])
    assert len(store) == 0 and store.value is None
    assert store.calls <= 5 * n
    if not per_session:
        assert pd.concat(out)["us"].tolist() == [1_000_000 * (i + 1) for i in range(n)] and pd.concat(out)["fire"].tolist() == [True] + [False] * (n - 1)
