"""Revised partial transcripts: stable prefixes (ST3), incremental trigger
(ST4) and segment latency (ST5).

Batch form: windows over (session ordered by ts). A session is one utterance
stream, so its window is bounded by the utterance, not by the data.
Stream form: ``applyInPandasWithState`` holds revisions until the watermark
passes them, so its output equals the batch form on the same input up to the
watermark, in any order of arrival. Spark's work for a call is much more than
that for a session's rows, so the key is one of a fixed number of hash buckets
of sessions, and calls do not grow with the sessions.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from parley.functions.text import words


def lcp_len(lists: Column) -> Column:
    """Length of the longest common prefix of an array of word arrays."""
    shortest = F.array_min(F.transform(lists, lambda a: F.size(a)))
    agree = F.aggregate(
        F.sequence(F.lit(0), F.greatest(shortest - 1, F.lit(0))),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("ok")),
        lambda acc, i: F.when(acc["ok"] & (i < shortest) &
                              (F.size(F.array_distinct(F.transform(lists, lambda a: F.get(a, i)))) == 1),
                              F.struct((acc["n"] + 1).alias("n"), F.lit(True).alias("ok")))
        .otherwise(F.struct(acc["n"].alias("n"), F.lit(False).alias("ok"))))
    return F.when(F.size(lists) == 0, F.lit(0)).otherwise(agree["n"])


def stable_prefix(partials: DataFrame, n: int = 2, session: str = "session", ts: str = "ts",
                  text: str = "text") -> DataFrame:
    """ST3: words unchanged over the last ``n`` revisions (fewer at the start of a session)."""
    w = W.partitionBy(session).orderBy(ts).rowsBetween(-(n - 1), 0)
    d = partials.withColumn("_w", words(text)).withColumn("_last", F.collect_list("_w").over(w))
    d = d.withColumn("stable_len", lcp_len(F.col("_last")))
    return d.select(session, ts, text, "stable_len",
                    F.array_join(F.slice("_w", 1, F.col("stable_len")), " ").alias("stable_text"))


def trigger_points(stable: DataFrame, k: int, session: str = "session", ts: str = "ts") -> DataFrame:
    """ST4: fire when at least ``k`` new stable units arrived since the last firing.

    Fired units are the running maximum of the stable length rounded down to a
    multiple of k; a revision fires when that number grows.
    """
    w = W.partitionBy(session).orderBy(ts).rowsBetween(W.unboundedPreceding, 0)
    d = stable.withColumn("_emit", F.floor(F.max("stable_len").over(w) / k) * k)
    d = d.withColumn("_prev", F.coalesce(F.lag("_emit").over(W.partitionBy(session).orderBy(ts)), F.lit(0)))
    return d.withColumn("fire", F.col("_emit") > F.col("_prev")).withColumn("emitted", F.col("_emit").cast("int")) \
            .drop("_emit", "_prev")


def segment_latency(fired: DataFrame, session: str = "session", ts: str = "ts") -> DataFrame:
    """ST5: per session first partial, first stable unit, first firing, final revision
    and their delays (seconds) from the first partial."""
    g = fired.groupBy(session).agg(
        F.min(ts).alias("first_partial"), F.min(F.when(F.col("stable_len") > 0, F.col(ts))).alias("first_stable"),
        F.min(F.when(F.col("fire"), F.col(ts))).alias("first_output"), F.max(ts).alias("final"))
    sec = lambda c: F.col(c).cast("double") - F.col("first_partial").cast("double")
    return g.select(session, "first_partial", "first_stable", "first_output", "final",
                    sec("first_stable").alias("stable_delay_s"), sec("first_output").alias("output_delay_s"),
                    sec("final").alias("total_s"))


# ---------------------------------------------------------------- streaming form (ST3 + ST4)
# of a bucket: its sessions side by side; held and last texts of all sessions one after the other, with the numbers of each session's
STATE_SCHEMA = ("sessions array<string>, emitted array<int>, seen_us array<bigint>, held_n array<int>, held_us array<bigint>, held_text array<string>, "
                "last_n array<int>, last_texts array<string>")
OUT_SCHEMA = "session string, us bigint, stable_len int, emitted int, fire boolean"
BUCKETS = 4_096
OUT_ROWS = 10_000                             # rows of a bucket that are given out at a time


def _lcp(lists: list[list[str]]) -> int:
    if not lists:
        return 0
    n = 0
    for col in zip(*lists):
        if len(set(col)) != 1:
            break
        n += 1
    return n


class _Session:
    """A session of the bucket at hand: held revisions in order, the last texts, units emitted, time of the last revision."""
    __slots__ = ("held", "last", "emitted", "seen")

    def __init__(self, held: list, last: list, emitted: int, seen: int):
        self.held, self.last, self.emitted, self.seen = held, last, emitted, seen

    def wake_ms(self, idle_ms: int) -> int:
        return -(-self.held[0][0] // 1000) if self.held else self.seen // 1000 + idle_ms


def _load(value: tuple) -> dict:
    names, emitted, seen, held_n, us, texts, last_n, last_texts = value
    out, h, m = {}, 0, 0
    for name, e, t, i, j in zip(names, emitted, seen, held_n, last_n, strict=True):
        out[name] = _Session(list(zip(us[h:h + i], texts[h:h + i], strict=True)), list(last_texts[m:m + j]), e, t)
        h, m = h + i, m + j
    return out


def _store(sessions: dict) -> tuple:
    all_ = list(sessions.values())
    return (list(sessions), [s.emitted for s in all_], [s.seen for s in all_], [len(s.held) for s in all_], [u for s in all_ for u, _ in s.held],
            [x for s in all_ for _, x in s.held], [len(s.last) for s in all_], [x for s in all_ for x in s.last])


def stable_stream(partials: DataFrame, n: int, k: int, session: str = "session", ts: str = "ts",
                  text: str = "text", watermark: str = "10 minutes", idle_ms: int = 600_000, buckets: int = BUCKETS) -> DataFrame:
    """ST3 + ST4 on a stream, in event-time order whatever the order of arrival.

    Per session the state holds the revisions the watermark has not passed yet, the last ``n`` texts and the
    units emitted. A timer at the oldest held revision releases it, in order, once the watermark is beyond it;
    ``idle_ms`` of event time after its last revision a session's state ends. Revisions behind the watermark
    are late and left out, as are those without a time; equal times are ordered by text.

    Sessions of one of ``buckets`` hash buckets share a state row and a timer (the earliest of theirs), and a call holds the bucket's live
    sessions; a session's rows do not depend on the others. ``buckets`` is part of the state's key: keep it over restarts.
    """

    def step(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        sessions = _load(state.get) if state.exists else {}
        watermark_ms = state.getCurrentWatermarkMs()
        passed = watermark_ms * 1000
        due = {name for name, s in sessions.items() if s.wake_ms(idle_ms) < watermark_ms}
        if not state.hasTimedOut:
            for pdf in pdfs:
                for name, us, x in zip(pdf["_session"].tolist(), pdf["_us"].tolist(), pdf["_text"].tolist(), strict=True):
                    if name not in sessions:
                        sessions[name] = _Session([], [], 0, 0)
                    sessions[name].held.append((us, x))
                    due.add(name)
        rows = []
        for name in due:
            s = sessions[name]
            s.held.sort()
            ready = [h for h in s.held if h[0] <= passed]
            s.held = s.held[len(ready):]
            for t, x in ready:
                s.last = (s.last + [x])[-n:]
                length = _lcp([v.split() for v in s.last])
                units = max(s.emitted, (length // k) * k)
                rows.append((name, t, length, units, units > s.emitted))
                s.emitted, s.seen = units, t
            if not s.held and s.wake_ms(idle_ms) <= watermark_ms:
                del sessions[name]
        if sessions:
            state.update(_store(sessions))
            state.setTimeoutTimestamp(min(s.wake_ms(idle_ms) for s in sessions.values()))
        elif state.exists:
            state.remove()
        for i in range(0, len(rows), OUT_ROWS):
            yield pd.DataFrame(rows[i:i + OUT_ROWS], columns=["session", "us", "stable_len", "emitted", "fire"])

    src = partials.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark).select(
        F.col(session).cast("string").alias("_session"), ts, F.unix_micros(ts).alias("_us"), F.coalesce(F.array_join(words(text), " "), F.lit("")).alias("_text"))
    src = src.withColumn("_bucket", F.pmod(F.xxhash64("_session"), F.lit(buckets)).cast("int"))
    out = src.groupBy("_bucket").applyInPandasWithState(step, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("session", F.timestamp_micros("us").alias("ts"), "stable_len", "emitted", "fire")
