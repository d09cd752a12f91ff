"""Operator 12, phrase collocation mining with mergeable Misra-Gries summaries.

1. N-grams are told apart by 64-bit hashes of (language, size, words) and dealt into hash partitions. A slice of the texts sends, for
   each partition, its n-grams with their local counts (a summary that has dropped nothing) and their mass.
2. A partition's summaries are merged one after the other. Its mass comes first in the sort order, so the capacity is fixed before
   the first merge: mass divided by the threshold, plus one. Beyond the capacity, the next largest count is taken off all counters.
   What is taken off adds up to less than the threshold, so every n-gram with that many occurrences survives; those whose counter plus
   all that was taken off stays below the threshold are left out.
3. Sizes go upwards: an n-gram is sent only if both its parts of one word less survived, looked up in a Bloom filter of fixed size.
   Words and pairs go first, unfiltered. False positives and a full filter cost work and change no result.
4. A second pass over the texts counts exactly the n-grams in the filter, as text, with map-side sums; fewer than ``threshold`` go.
5. Cuts, scores (decimals of 38 digits, integral division), phrases inside longer ones and the report of each language are joins and
   windows over the exact counts.

Null text has no words and a null language is ``und``. Words keep their bytes but for A-Z, which are lowered. Repeated rows and ids
count as often as they occur (the id takes no part). Very long texts make a slice of their own. Ties go by phrase in byte order; an
empty table gives no rows; extra columns take no part.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import common as C
from parley.operators.common import broadcast_if_small, top_n_per_group

SIZES = 5
THRESHOLD = 100
TOP = 2000
CAPACITY = 1 << 20        # counters that a hash partition is laid out for
FILTER_BITS = 1 << 26     # of the Bloom filter, 8 MB
BREAKS = ".,;:!?\n\x0b\x0c\r"
GAPS = " \t"
MERGE_AT = 1 << 18        # pending counts that are merged at once, at least

_breaks = np.zeros(256, bool)
_breaks[list(BREAKS.encode())] = True
_ink = ~_breaks
_ink[list(GAPS.encode())] = False


def segments(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(bytes lowered, word starts, word hashes, row and piece number of each word)."""
    data, offs = C.text_bytes(texts)
    data = C.LOWER[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return data, none, np.zeros(0, np.uint64), none, none
    ink = _ink[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(ink & (np.append(True, ~ink[:-1]) | edge[:-1]))
    ends = np.flatnonzero(ink & (np.append(~ink[1:], True) | edge[1:])) + 1
    row = np.searchsorted(offs, starts, "right") - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(C.BYTE_VALUE[data] * C.powers(C.BASE, n), out=sums[1:])
    h = C.mix((sums[ends] - sums[starts]) * C.powers(C.BASE_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))
    broken = np.cumsum(_breaks[data])[starts]
    new = np.zeros(len(starts), bool)
    new[1:] = (row[1:] != row[:-1]) | (broken[1:] != broken[:-1])
    return data, starts, h, row, np.cumsum(new)


def grams(h: np.ndarray, piece: np.ndarray, lang: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and whether they stand in one piece; ``lang`` is a hash for each word."""
    n = max(0, len(h) - size + 1)
    return C.mix(C.window_hashes(h, size) ^ lang[:n] * np.uint64(2 * size + 1)), piece[:n] == piece[size - 1:][:n]


def probes(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return (gram & mask).astype(np.int64), (gram >> np.uint64(32) & mask).astype(np.int64)


def contains(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Whether each n-gram may have survived; ``bits`` are the filter's bytes."""
    a, b = probes(gram)
    return ((bits[a >> 3] >> (a & 7).astype(np.uint8)) & (bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def _lang_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)


def _summaries(sizes: tuple[int, ...], buckets: int, bits):
    """Local counts of a slice's n-grams by (size, hash partition); ``bits`` filters on both parts of an n-gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 0):
                _, _, h, row, piece = segments(part.column(0))
                lang = C.mix(_lang_of(part))[row]
                out = []
                for size in sizes:
                    g, ok = grams(h, piece, lang, size)
                    if bits is not None and len(g):
                        kept = contains(bits.value, grams(h, piece, lang, size - 1)[0])
                        ok &= kept[:len(g)] & kept[1:len(g) + 1]
                    g, times = np.unique(g[ok], return_counts=True)
                    at = (C.mix(g) % np.uint64(buckets)).astype(np.int32)
                    order = np.argsort(at, kind="stable")
                    g, times, at = g[order], times[order].astype(np.uint32), at[order]
                    cut = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
                    for a, b in zip(cut, np.append(cut[1:], len(at)), strict=True):
                        out.append((size, int(at[a]), 0, int(times[a:b].sum(dtype=np.int64)), None, None))
                        out.append((size, int(at[a]), 1, 0, g[a:b].tobytes(), times[a:b].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        ["size", "bucket", "kind", "mass", "grams", "times"])
    return run


class Summary:
    """A Misra-Gries summary of one hash partition, with a capacity above mass / threshold."""

    def __init__(self, mass: int, threshold: int):
        self.capacity = mass // threshold + 1
        self.threshold, self.taken = threshold, 0
        self.gram, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, gram: np.ndarray, count: np.ndarray) -> None:
        self.pending.append((gram, count))
        self.waiting += len(gram)
        if self.waiting > max(MERGE_AT, self.capacity):
            self.merge()

    def merge(self) -> None:
        gram = np.concatenate([self.gram, *[g for g, _ in self.pending]])
        count = np.concatenate([self.count, *[c.astype(np.int64) for _, c in self.pending]])
        self.pending, self.waiting = [], 0
        self.gram, at = np.unique(gram, return_inverse=True)
        self.count = np.bincount(at, count, minlength=len(self.gram)).astype(np.int64) if len(gram) else np.zeros(0, np.int64)
        if len(self.gram) > self.capacity:
            off = int(np.partition(self.count, len(self.count) - self.capacity - 1)[len(self.count) - self.capacity - 1])
            self.taken += off
            left = self.count > off
            self.gram, self.count = self.gram[left], self.count[left] - off

    def survivors(self) -> np.ndarray:
        self.merge()
        assert self.taken < self.threshold
        return self.gram[self.count + self.taken >= self.threshold]


def _merge(threshold: int):
    """Survivors of each hash partition, from rows sorted by (size, bucket, kind): masses first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(summary):
            return pa.RecordBatch.from_arrays([pa.array(summary.survivors().view(np.int64))], ["gram"])
        now, mass, summary = None, 0, None
        for batch in batches:
            for size, bucket, kind, m, g, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (size, bucket) != now:
                    if summary:
                        yield done(summary)
                    now, mass, summary = (size, bucket), 0, None
                if kind == 0:
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(mass, threshold)
                summary.add(np.frombuffer(g, np.uint64), np.frombuffer(t, np.uint32))
        if summary:
            yield done(summary)
    return run


def _filter_bits(survivors: DataFrame, into: np.ndarray) -> np.ndarray:
    """The filter with the survivors added: words of 64 bits are or-ed in Spark; at most FILTER_BITS / 64 of them come to the driver."""
    mask = F.lit(FILTER_BITS - 1).cast("long")
    at = survivors.select(F.explode(F.array(F.col("gram").bitwiseAND(mask), F.shiftrightunsigned("gram", 32).bitwiseAND(mask))).alias("at"))
    one = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = at.select(F.shiftright("at", 6).cast("int").alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = into.view(np.int64).copy()
    out[words.column(0).to_numpy()] |= words.column(1).to_numpy()
    return out.view(np.uint8)


def _exact(sizes: int, bits):
    """(lang, size, phrase, f) of a slice: exact local counts of the n-grams in the filter; size 0 holds the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 0):
                data, starts, h, row, piece = segments(part.column(0))
                if not len(h):
                    continue
                names = part.column(2)
                code = names.dictionary_encode()
                per = np.bincount(code.indices.to_numpy(zero_copy_only=False)[row], minlength=len(code.dictionary))
                yield _counted(code.dictionary, 0, pa.array([""] * len(per)), per)
                lang = C.mix(_lang_of(part))[row]
                # each word up to the next one's start; what follows a word is trimmed off
                text = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data.tobytes()))
                for size in range(1, sizes + 1):
                    g, ok = grams(h, piece, lang, size)
                    at = np.flatnonzero(ok)
                    at = at[contains(bits.value, g[at])]
                    _, first, times = np.unique(g[at], return_index=True, return_counts=True)
                    at = at[first]
                    words = [pc.utf8_rtrim(text.take(pa.array(at + i)), characters=BREAKS + GAPS) for i in range(size)]
                    phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if size > 1 else words[0]
                    yield _counted(names.take(pa.array(row[at])), size, phrase.cast(pa.string()), times)
    return run


def _counted(lang: pa.Array, size: int, phrase: pa.Array, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(np.full(len(lang), size, np.int32)), phrase, pa.array(times.astype(np.int64))],
                                      ["lang", "size", "phrase", "f"])


def hash_partitions(spark: SparkSession, total_bytes: int, threshold: int) -> int:
    """So many that a partition's share of the mass (at most one n-gram for two bytes) fits ``CAPACITY`` counters; one for each shuffle partition at least."""
    return max(C.partitions(spark), -(-total_bytes // (2 * threshold * CAPACITY)))


def frequent(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: int = SIZES, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, size, phrase, f): exact counts of every n-gram that occurs ``threshold`` times in its language; size 0 holds the number of words."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    d = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.xxhash64(lang).alias("lang_hash"), lang.alias("lang"))
    buckets = hash_partitions(spark, d.agg(F.sum(F.octet_length("text"))).first()[0] or 0, threshold)
    bits, sent = np.zeros(FILTER_BITS // 8, np.uint8), None
    for step in ((1, 2), *[(s,) for s in range(3, sizes + 1)]):
        parts = d.select("text", "lang_hash").mapInArrow(_summaries(step, buckets, sent),
                                                         "size int, bucket int, kind int, mass long, grams binary, times binary")
        kept = parts.repartition("size", "bucket").sortWithinPartitions("size", "bucket", "kind").mapInArrow(_merge(threshold), "gram long")
        bits = _filter_bits(kept, bits)
        if sent is not None:
            sent.unpersist()
        sent = spark.sparkContext.broadcast(bits)
    counted = d.mapInArrow(_exact(sizes, sent), "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter((F.col("f") >= threshold) | (F.col("size") == 0)).checkpoint()


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: int = SIZES, threshold: int = THRESHOLD,
                 top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    counts = frequent(docs, text_col, lang_col, sizes, threshold)
    total = broadcast_if_small(counts.filter("size = 0").select("lang", F.col("f").alias("n")), 100_000)
    phrases = counts.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.lit(sizes)), " ").alias("rest"))
    part = counts.filter("size > 0").select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(total, "lang")
    score = F.expr("(1000bd * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice("w", i, s), " "))))
    inside = phrases.filter("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    best = best.join(inside, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * a")
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = top_n_per_group(best, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, rank_col="rank")
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
