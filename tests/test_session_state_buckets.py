"""The state API's sessions share calls and state by hash bucket; rows are those of a state for each session."""
import os
import random

import pandas as pd
import pytest

from parley.streaming import sessions as SS
from tests.test_sessions import At, K, N, Store, run, write


class BucketStore(Store):
    """Stands for the handle and all states of one bucket, and counts the calls."""

    def __init__(self):
        super().__init__()
        self.lists, self.values = [], {}

    def getListState(self, *_):
        return self

    def getValueState(self, name, *_):
        self.values[name] = value = Store()
        value.registerTimer = None
        return Store.Value(Counted(self, value))

    def appendValue(self, value):
        self.calls += 1
        self.lists.append(value)

    def get(self):
        self.calls += 1
        return iter(list(self.lists))

    def put(self, values):
        self.calls += 1
        self.lists = list(values)

    def clear(self):
        self.put([])


class Counted:
    """A value whose calls count for the bucket."""

    def __init__(self, bucket, own):
        object.__setattr__(self, "bucket", bucket)
        object.__setattr__(self, "own", own)

    def __getattr__(self, name):
        return self.bucket.calls if name == "calls" else getattr(self.own, name)

    def __setattr__(self, name, value):
        setattr(self.bucket if name == "calls" else self.own, name, value)


def played(processor, store, key, parts, steps, columns):
    processor.init(store)
    for part in parts:
        list(processor.handleInputRows((key,), iter([pd.DataFrame(part, columns=["session", "us", "line"])[columns]]), At(0)))
    frames = []
    for w in steps:
        seen = set()
        while fire := {t for t in store.timers if t <= w} - seen:
            seen |= fire
            frames += [f for t in sorted(fire) for f in processor.handleExpiredTimer((key,), At(w), At(t))]
        store.timers = [t for t in store.timers if t > w]
    return [tuple(r) for f in frames for r in f.itertuples(index=False)]


def histories(sessions, length):
    r = random.Random(7)
    at = [0] * sessions
    rows = []
    for s in range(sessions):
        for _ in range(length):
            at[s] += r.choice([0, 400, 5_000_500, 70_000_000])
            rows.append((f"s{s}" if s else None, 1_000_000 + at[s], " ".join("abcdef"[:r.randint(0, 6)])))
    return rows


@pytest.mark.parametrize("per_session", [False, True])
def test_rows_of_a_bucket_are_those_of_its_sessions_alone(per_session):
    rows = histories(9, 12)
    shuffled = random.Random(1).sample(rows, len(rows))
    parts, steps = [shuffled[i::3] for i in range(3)], (2_000, 9_000, 100_500, 400_000, 10_000_000)
    store = BucketStore()
    got = played(SS.Buckets(N, K, 60_000, per_session), store, 5, parts, steps, ["session", "us", "line"])
    want = []
    for name in {s for s, _, _ in rows}:
        one = [[x for x in p if x[0] == name] for p in parts]
        want += played(SS.Revisions(N, K, 60_000, per_session), Store(), name, one, steps, ["us", "line"])
    assert len(got) == len(want) and sorted(got, key=repr) == sorted(want, key=repr)
    assert not store.lists and all(v.value is None for v in store.values.values())


def test_calls_do_not_grow_with_the_sessions_of_a_bucket():
    calls = []
    for sessions in (5, 500):
        store = BucketStore()
        rows = [(f"s{s}", 1_000_000 * (1 + i) + s, "a b c") for s in range(sessions) for i in range(4)]
        got = played(SS.Buckets(N, K, 60_000, False), store, 0, [rows[::2], rows[1::2]], (1_000_000,), ["session", "us", "line"])
        assert len(got) == 4 * sessions
        calls.append(store.calls)
    assert calls[1] <= calls[0] + 4


def test_one_bucket_and_a_state_for_each_session_give_the_same_rows(spark, tmp_out):
    src = tmp_out + "/src"
    os.mkdir(src)
    r = random.Random(4)
    rows = [(s, 1000 * i + r.randint(0, 900), " ".join("one two three four".split()[:r.randint(0, 4)])) for s in ("a", "b", None, "d") for i in range(5)]
    write(src, 0, r.sample(rows, len(rows)))
    write(src, 1, [("end", 3_600_000, "")])
    write(src, 2, [("end", 9_000_000, "")])
    got = []
    for buckets in (1, 0):
        os.mkdir(f"{tmp_out}/{buckets}")
        form = lambda *a, b=buckets, **k: SS.stable_sessions(*a, buckets=b, **k)
        got.append(sorted((tuple(x) for x in run(spark, src, form, f"{tmp_out}/{buckets}").filter("session is null or session <> 'end'").collect()), key=repr))
    assert got[0] == got[1] and len(got[0]) == len(rows)
