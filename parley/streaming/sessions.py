"""ST3, ST4 and ST5 with ``transformWithStateInPandas``: revisions of a session in event-time order, whatever the order of arrival.

Sessions of one of ``buckets`` hash buckets share their state, in the state store (RocksDB) and not in Python, and the calls to it, which are slow from Python:
the held revisions, appended for each micro-batch as they come; of each live session the last ``n`` texts, units emitted, the time of the last revision
and the session's first times; and the one event-time timer that counts, at the earliest held revision or end of a session. When the watermark has passed it, all
revisions that are due are processed in order of their session and time, and their rows go out together. So the Python worker holds a bucket's held
revisions. A session's rows do not depend on the others of its bucket. ``buckets`` is part of the state's key: keep it over restarts.

With ``buckets=0`` each session has a state of its own, for sessions of so many revisions that a worker can't hold them: a map from a millisecond to the
revisions that become due then, each millisecond's read and removed in turn. The worker then holds a session's held times and one millisecond's
revisions, and the calls grow with the revisions.

A session ends ``idle_ms`` of event time after its last revision: its state is cleared, and the latency form gives out its row. A later
revision of the same session starts a new one. Revisions behind the watermark are late and left out, as are those without a time; equal times go by
text. A null session is a session; null text is empty. Empty input gives no rows.
"""
from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from parley.functions.text import words
from parley.streaming.revisions import _lcp

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REVISION_ROWS = "session string, us bigint, stable_len int, emitted int, fire boolean"
NEW = ([], 0, None, None, None, None, None)   # what is known of a session before its first revision is processed, and no timer
SEEN = 2
BUCKETS = 4_096
OUT_ROWS = 4_096                              # rows that are given out, or revisions that are appended as one value, at a time
SESSION_ROWS = "session string, first_us bigint, stable_us bigint, output_us bigint, final_us bigint"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The state store that ``transformWithState`` needs, for the queries started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class Revisions(StatefulProcessor):
    """Stable prefixes and firings of each revision (``per_session`` False), or one row of first times for each session."""

    def __init__(self, n: int, k: int, idle_ms: int, per_session: bool):
        self.n, self.k, self.idle_ms, self.per_session = n, k, idle_ms, per_session

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "due_ms bigint", "revisions string")
        self.known = handle.getValueState("known", "texts array<string>, emitted int, seen_us bigint, first_us bigint, stable_us bigint, output_us bigint, wake_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for pdf in rows:
            due: dict[int, list] = {}
            for us, text in zip(pdf["us"].tolist(), pdf["line"].tolist(), strict=True):
                if us > passed:
                    due.setdefault(-(-us // 1000), []).append([us, text])
            for ms, new in due.items():
                have = self.held.getValue((ms,))
                self.held.updateValue((ms,), (json.dumps(json.loads(have[0]) + new if have else new),))
            if due:
                *known, wake = self.known.get() or NEW
                if wake is None or min(due) < wake:
                    self._sleep(known, min(due))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        *known, wake = self.known.get() or NEW
        if wake is None or wake > passed:  # of a time before an earlier revision came, or of a session that has ended
            return
        times = sorted(ms for ms, in self.held.keys())
        later = [ms for ms in times if ms > passed]
        out = []
        for ms in times[:len(times) - len(later)]:
            if known[SEEN] is not None and self._idle(known) < ms:
                out += self._ended(key[0], known)
                known = list(NEW[:-1])
            out += self._release(key[0], known, sorted(json.loads(self.held.getValue((ms,))[0])))
            if later:
                self.held.removeKey((ms,))
            if len(out) >= OUT_ROWS:
                yield self._frame(out)
                out = []
        if times and not later:
            self.held.clear()
        if known[SEEN] is not None and self._idle(known) <= passed:
            out += self._ended(key[0], known)
            known = list(NEW[:-1])
        wakes = later[:1] + ([self._idle(known)] if known[SEEN] is not None else [])
        if wakes:
            self._sleep(known, min(wakes))
        else:
            self.known.clear()
        if out:
            yield self._frame(out)

    def _sleep(self, known: list, ms: int) -> None:
        self.known.update((*known, ms))
        self.handle.registerTimer(ms)

    def _idle(self, known: list) -> int:
        return -(-known[SEEN] // 1000) + self.idle_ms

    def _ended(self, session, known: list) -> list[tuple]:
        _, _, seen, first, stable, output = known
        return [(session, first, stable, output, seen)] if self.per_session else []

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[c.split()[0] for c in (SESSION_ROWS if self.per_session else REVISION_ROWS).split(", ")], dtype=object)

    def _release(self, session, known: list, revisions: list) -> list[tuple]:
        """Rows of one millisecond's revisions; ``known`` is brought up to date."""
        last, emitted, seen, first, stable, output = known
        last, rows = list(last), []
        for us, text in revisions:
            if seen is not None and us < seen:
                raise RuntimeError("revisions of a session came out of order")
            last = (last + [text])[-self.n:]
            length = _lcp([t.split(" ") if t else [] for t in last])
            units = max(emitted, length // self.k * self.k)
            rows.append((session, us, length, units, units > emitted))
            first = us if first is None else first
            stable = us if stable is None and length > 0 else stable
            output = us if output is None and units > emitted else output
            emitted, seen = units, us
        known[:] = last, emitted, seen, first, stable, output
        return [] if self.per_session else rows

    def close(self) -> None:
        pass


class Buckets(Revisions):
    """``Revisions`` of all sessions of a hash bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "revisions string")         # [session, us, text] of up to OUT_ROWS revisions
        self.known = handle.getValueState("known", "sessions string")       # [session, what is known of it] of all live sessions
        self.wake = handle.getValueState("wake", "wake_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        first = None
        for pdf in rows:
            new = [x for x in zip(pdf["session"].tolist(), pdf["us"].tolist(), pdf["line"].tolist(), strict=True) if x[1] > passed]
            for i in range(0, len(new), OUT_ROWS):
                self.held.appendValue((json.dumps(new[i:i + OUT_ROWS]),))
            first = min([us for _, us, _ in new] + ([] if first is None else [first]), default=None)
        if first is not None:
            wake = (self.wake.get() or (None,))[0]
            if wake is None or -(-first // 1000) < wake:
                self._wake(-(-first // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        wake = (self.wake.get() or (None,))[0]
        if wake is None or wake > passed:  # of a time before an earlier revision came
            return
        known = dict(json.loads((self.known.get() or ("[]",))[0]))
        due: dict = {}
        later: list = []
        for chunk, in self.held.get():
            for session, us, text in json.loads(chunk):
                if -(-us // 1000) <= passed:
                    due.setdefault(session, []).append([us, text])
                else:
                    later.append((session, us, text))
        out: list = []
        for session in [*due, *[x for x in known if x not in due]]:
            state = known.pop(session, None) or list(NEW[:-1])
            for us, text in sorted(due.get(session, ())):
                if state[SEEN] is not None and self._idle(state) < -(-us // 1000):
                    out += self._ended(session, state)
                    state = list(NEW[:-1])
                out += self._release(session, state, [[us, text]])
            if state[SEEN] is not None and self._idle(state) <= passed:
                out += self._ended(session, state)
            else:
                known[session] = state
            while len(out) >= OUT_ROWS:
                yield self._frame(out[:OUT_ROWS])
                out = out[OUT_ROWS:]
        if due:
            if later:
                self.held.put([(json.dumps(later[i:i + OUT_ROWS]),) for i in range(0, len(later), OUT_ROWS)])
            else:
                self.held.clear()
        if known:
            self.known.update((json.dumps(list(known.items())),))
        else:
            self.known.clear()
        wakes = [-(-us // 1000) for _, us, _ in later] + [self._idle(state) for state in known.values()]
        if wakes:
            self._wake(min(wakes))
        else:
            self.wake.clear()
        if out:
            yield self._frame(out)

    def _wake(self, ms: int) -> None:
        self.wake.update((ms,))
        self.handle.registerTimer(ms)


def _stream(partials: DataFrame, n: int, k: int, idle_ms: int, per_session: bool, session: str, ts: str, text: str, watermark: str, buckets: int) -> DataFrame:
    src = partials.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark).select(
        F.col(session).cast("string").alias("session"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("us"),
        F.coalesce(F.array_join(words(text), " "), F.lit("")).alias("line"))
    schema = SESSION_ROWS if per_session else REVISION_ROWS
    if not buckets:
        return src.groupBy("session").transformWithStateInPandas(Revisions(n, k, idle_ms, per_session), schema, "append", "EventTime")
    src = src.withColumn("bucket", F.pmod(F.xxhash64("session"), F.lit(buckets)).cast("int"))
    return src.groupBy("bucket").transformWithStateInPandas(Buckets(n, k, idle_ms, per_session), schema, "append", "EventTime")


def stable_sessions(partials: DataFrame, n: int, k: int, session: str = "session", ts: str = "ts", text: str = "text",
                    watermark: str = "10 minutes", idle_ms: int = 600_000, buckets: int = BUCKETS) -> DataFrame:
    """ST3 + ST4: session, ts, stable_len, emitted, fire of each revision. Start the query inside ``rocksdb_state``."""
    out = _stream(partials, n, k, idle_ms, False, session, ts, text, watermark, buckets)
    return out.select("session", F.timestamp_micros("us").alias("ts"), "stable_len", "emitted", "fire")


def session_latency(partials: DataFrame, n: int, k: int, session: str = "session", ts: str = "ts", text: str = "text",
                    watermark: str = "10 minutes", idle_ms: int = 600_000, buckets: int = BUCKETS) -> DataFrame:
    """ST5: for each session that has ended its first partial, first stable unit, first firing, final revision and their delays in seconds.
    Start the query inside ``rocksdb_state``."""
    out = _stream(partials, n, k, idle_ms, True, session, ts, text, watermark, buckets)
    delay = lambda c: (F.col(c) - F.col("first_us")) / F.lit(1e6)
    return out.select("session", *[F.timestamp_micros(f"{c}_us").alias(name) for c, name in (
        ("first", "first_partial"), ("stable", "first_stable"), ("output", "first_output"), ("final", "final"))],
        delay("stable_us").alias("stable_delay_s"), delay("output_us").alias("output_delay_s"), delay("final_us").alias("total_s"))
