"""Operator 7, language-model scoring by context-tree weighting over bytes.

* Counting. Runs of ``depth + 1`` bytes (texts lower-cased in A-Z, led by ``depth`` zero bytes) are counted over every text, training
  and held out apart; each task sums its own counts before the shuffle. Counts of shorter contexts are sums over these. No run is left out.
* Tree. Each byte is eight binary decisions from the high bit. A node is a context of 0 to ``depth`` bytes with the bits decided so far; it
  has a Krichevsky-Trofimov estimate of its counts. From the deepest contexts up, a node's weighted probability is the mean of its own
  block probability and the product of its children's; the share of its own part is its mixing weight.
* Distribution. The runs are partitioned by the last ``TOP`` bytes of their context, so each task holds whole subtrees of the nodes at
  depth ``TOP`` and below. The nodes above come from the sums of those subtrees on the driver; they are at most as many as there are
  runs of ``TOP`` bytes (under four million in UTF-8; 33,573 on 0.5 GB) and are broadcast.
* Scoring. A bit's probability mixes the estimates of all depths by these weights, from the deepest context seen in training. Every run of
  the corpus gets its log10 probability where its subtree is. Texts add up those of the ``local`` most frequent runs from a
  broadcast table; their other runs, each rare, are joined with the rest of the runs. Results do not depend on ``local``.
  The score is the sum over the bytes and one end byte, so ``-score * log2(10) / bytes`` is the code length per byte.

The base score is an add-one unigram model over words by their hashes, summed in the same way.

Null text counts as empty: it has only the end token. Null ids count as the empty text for the fold. Repeated rows each return a row and are
counted each. With no training texts every bit has probability one half.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C

DEPTH = 5
TOP = 3  # subtrees are dealt out by this many bytes of context
LOCAL = 1 << 19  # runs, and words, whose values every task holds, in a table of 16 MB
EMPTY = np.uint64((1 << 64) - 1)
END = 0x01  # put after each text
LOG10 = math.log(10)
CHUNK = 1 << 20


def runs(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, row): for each byte of each text and its end byte, the ``depth`` bytes before it and itself as one number."""
    data, offs = C.text_bytes(texts)
    n = len(texts)
    sizes = np.diff(offs)
    starts = offs[:-1] + np.arange(n) * (depth + 1) + depth  # each text is led by zeros and closed by the end byte
    flat = np.zeros(len(data) + n * (depth + 1), np.uint8)
    row = np.repeat(np.arange(n), sizes + 1)
    at = np.arange(len(row)) + (row + 1) * depth
    keep = np.ones(len(row), bool)
    keep[np.cumsum(sizes + 1) - 1] = False
    flat[at[keep]] = C.LOWER[data]
    flat[starts + sizes] = END
    code = np.zeros(len(at), np.uint64)
    for back in range(depth, -1, -1):
        code = code << np.uint64(8) | flat[at - back]
    return code, row


def _counted(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return u, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(u)).astype(np.int64)


def _counts(codes_of):
    """Sums of the codes that ``codes_of`` takes from batches with the text first, one row for each code of a task (or of some millions of codes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0
        for batch in batches:
            for part in C.slices(batch, 0, CHUNK):
                u, c = np.unique(codes_of(part), return_counts=True)
                codes.append(u)
                counts.append(c)
                held += len(u)
                if held > 4_000_000:  # a task holds a bounded table: it is summed, and sent on if still large
                    u, c = _counted(codes, counts)
                    codes, counts, held = [u], [c], len(u)
                    if held > 2_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c)], ["code", "n"])
                        codes, counts, held = [], [], 0
        if codes:
            u, c = _counted(codes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c)], ["code", "n"])
    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series after a shift."""
    shift = np.zeros(len(x))
    y = x.astype(np.float64)
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


class Tree:
    """Nodes of the weighted tree from depth ``top`` to ``depth`` as sorted arrays for each (depth, bits decided).

    ``deeper`` holds, for each number of bits, nodes at ``depth`` with the summed log probabilities of their children, if the tree
    goes on below; ``sums`` holds the same for the nodes at ``top - 1``, and ``under`` puts the nodes of that tree on top."""

    def __init__(self, code: np.ndarray, count: np.ndarray, depth: int, top: int = 0, deeper: dict[int, tuple[np.ndarray, np.ndarray]] | None = None):
        self.depth = depth
        self.nodes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for bits in range(8):
            below = deeper[bits] if deeper else None
            for d in range(depth, top - 1, -1):
                tail = code & np.uint64((1 << 8 * (d + 1)) - 1)
                child = tail >> np.uint64(7 - bits)  # context, the bits decided and the next bit
                ids, inverse = np.unique(child >> np.uint64(1), return_inverse=True)
                n = np.bincount(inverse, weights=count, minlength=len(ids))
                one = np.bincount(inverse, weights=count * (child & np.uint64(1)), minlength=len(ids))
                own = log_gamma(one + 0.5) + log_gamma(n - one + 0.5) - log_gamma(n + 1) - math.log(math.pi)
                total, weight = own, np.ones(len(ids))
                if below is not None:
                    children = np.bincount(np.searchsorted(ids, below[0]), weights=below[1], minlength=len(ids))
                    total = np.logaddexp(own, children) - math.log(2)
                    weight = np.exp(np.clip(own - math.log(2) - total, -700, 0))
                self.nodes[d, bits] = ids, weight.astype(np.float32), (one + 0.5) / (n + 1)  # single precision rounds to 1 from n = 2**24
                below = ids & np.uint64((1 << (8 * max(d - 1, 0) + bits)) - 1), total
            up, inverse = np.unique(below[0], return_inverse=True)
            self.sums[bits] = up, np.bincount(inverse, weights=below[1], minlength=len(up)).astype(np.float64)

    def under(self, nodes: dict) -> Tree:
        self.nodes |= nodes
        return self

    def log_probabilities(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each code given the bytes before it."""
        out = np.zeros(len(code))
        for bits in range(8):
            bit = (code >> np.uint64(7 - bits) & np.uint64(1)).astype(bool)
            p = np.full(len(code), 0.5)
            seen = np.zeros(len(code), bool)
            for d in range(self.depth, -1, -1):
                ids, weight, one = self.nodes[d, bits]
                node = (code & np.uint64((1 << 8 * (d + 1)) - 1)) >> np.uint64(8 - bits)
                at = np.minimum(np.searchsorted(ids, node), len(ids) - 1) if len(ids) else np.zeros(len(node), np.int64)
                here = ids[at] == node if len(ids) else np.zeros(len(node), bool)
                if not here.any():
                    continue
                w = np.where(seen, weight[at], 1.0)
                p = np.where(here, w * one[at] + (1 - w) * p, p)
                seen |= here
            out += np.log10(np.where(bit, p, 1 - p))
        return out


def _marked_runs(depth: int):
    """Codes of runs of (text, training) batches; one bit above the run tells training texts."""
    def codes(part: pa.RecordBatch) -> np.ndarray:
        code, row = runs(part.column(0), depth)
        return code | part.column(1).cast(pa.uint8()).to_numpy(zero_copy_only=False).astype(np.uint64)[row] << np.uint64(8 * (depth + 1))
    return codes


def corpus_runs(d: DataFrame, depth: int, top: int) -> DataFrame:
    """(top_bytes, code, n, m): how often each run stands in training texts, and in all; dealt out by the context's last ``top`` bytes."""
    bit = 8 * (depth + 1)
    code = F.col("code").bitwiseAND(F.lit((1 << bit) - 1))
    raw = (d.select("text", "training").mapInArrow(_counts(_marked_runs(depth)), "code long, n long")
           .select(F.shiftright(code, 8).bitwiseAND(F.lit((1 << 8 * top) - 1)).alias("top_bytes"), code.alias("code"),
                   (F.shiftright("code", bit) * F.col("n")).alias("n"), F.col("n").alias("m")))
    return (raw.repartition(C.partitions(d.sparkSession), "top_bytes").groupBy("top_bytes", "code")
            .agg(F.sum("n").alias("n"), F.sum("m").alias("m")).checkpoint())


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """code, n and m of a task's whole part of the runs, by ascending code."""
    parts = [[b.column(i).to_numpy() for i in (1, 2, 3)] for b in batches if b.num_rows]
    if not parts:
        return [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    code, n, m = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(code)
    return [code[order].view(np.uint64), n[order], m[order]]


def _subtree_sums(depth: int, top: int):
    """(bits, node, total): the nodes above a task's subtrees with its share of their children's log probability."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, _ = _columns(batches)
        for bits, (node, total) in Tree(code[n > 0], n[n > 0], depth, top).sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), bits, np.int32)), pa.array(node.view(np.int64)), pa.array(total)], ["bits", "node", "total"])
    return run


def _run_values(depth: int, top: int, upper):
    """(code, m, value): log10 probability of each run of a task's subtrees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, m = _columns(batches)
        tree = Tree(code[n > 0], n[n > 0], depth, top).under(upper.value)
        for at in range(0, len(code), CHUNK):
            part = code[at:at + CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(m[at:at + CHUNK]), pa.array(tree.log_probabilities(part))], ["code", "m", "value"])
    return run


def run_values(d: DataFrame, depth: int = DEPTH, top: int = TOP) -> DataFrame:
    """(code, m, value) of every run of the rows of ``d`` (text, training): its occurrences and its log10 probability by the training rows."""
    top = min(top, depth)
    counted = corpus_runs(d, depth, top)
    nodes = {}
    if top:
        sums = counted.mapInArrow(_subtree_sums(depth, top), "bits int, node long, total double").groupBy("bits", "node").agg(F.sum("total").alias("total")).toArrow()
        bits, node, total = (sums[c].to_numpy() for c in ("bits", "node", "total"))
        short = (counted.filter("n > 0").groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * top) - 1)).alias("code"))
                 .agg(F.sum("n").alias("n")).toArrow())  # runs of ``top`` bytes
        nodes = Tree(short["code"].to_numpy().view(np.uint64), short["n"].to_numpy(), top - 1,
                     deeper={b: (node[bits == b].view(np.uint64), total[bits == b]) for b in range(8)}).nodes
    upper = d.sparkSession.sparkContext.broadcast(nodes)
    return counted.mapInArrow(_run_values(depth, top, upper), "code long, m long, value double").checkpoint()


def hash_table(code: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of an open-addressed table, a power of two of slots, at most half full."""
    bits = max(4, (2 * len(code)).bit_length())
    keys, values = np.full(1 << bits, EMPTY), np.zeros(1 << bits)
    todo, slot = np.arange(len(code)), ((code * C.BASE) >> np.uint64(64 - bits)).astype(np.int64)
    while len(todo):
        at = slot[todo]
        free = keys[at] == EMPTY
        keys[at[free]] = code[todo[free]]
        done = keys[at] == code[todo]
        values[at[done]] = value[todo[done]]
        todo = todo[~done]
        slot[todo] = (slot[todo] + 1) & ((1 << bits) - 1)
    return keys, values


def look_up(table: tuple[np.ndarray, np.ndarray], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the codes, zero where there is none, and the places of those without."""
    keys, values = table
    bits = len(keys).bit_length() - 1
    slot = ((code * C.BASE) >> np.uint64(64 - bits)).astype(np.int64)
    out = values[slot]
    todo = np.flatnonzero(keys[slot] != code)
    missing = []
    while len(todo):
        key = keys[slot[todo]]
        none, found = key == EMPTY, key == code[todo]
        missing.append(todo[none])
        out[todo[found]] = values[slot[todo[found]]]
        todo = todo[~(none | found)]
        slot[todo] = (slot[todo] + 1) & ((1 << bits) - 1)
    lost = np.concatenate(missing) if missing else todo
    out[lost] = 0
    return out, lost


def _partial_sums(codes_of, frequent):
    """For each (key_id, key_text, text): one row with the number and the summed values of its frequent codes, and one for each of its other
    codes with its count."""
    names = ["key_id", "key_text", "code", "tf", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2, CHUNK):
                n = part.num_rows
                code, row = codes_of(part.column(2))
                value, lost = look_up(frequent.value, code)
                sums = np.bincount(row, weights=value, minlength=n).astype(np.float64)
                found = np.bincount(row, minlength=n) - np.bincount(row[lost], minlength=n)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.nulls(n, pa.int64()), pa.array(found.astype(np.int64)), pa.array(sums)], names)
                code, row = code[lost], row[lost]
                order = np.lexsort((code, row))
                code, row = code[order], row[order]
                new = np.ones(len(code), bool)
                new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                r = pa.array(row[first])
                yield pa.RecordBatch.from_arrays([part.column(0).take(r), part.column(1).take(r), pa.array(code[first].view(np.int64)),
                                                  pa.array(np.diff(np.append(first, len(code)))), pa.nulls(len(first), pa.float64())], names)
    return run


def text_sums(d: DataFrame, codes_of, values: DataFrame, unseen: float, local: int) -> DataFrame:
    """(key_id, key_text, t, k, s) of keyed texts: how many codes, how many of them in ``values`` (code, m, value), and their summed values,
    ``unseen`` for codes that are not in it; equal rows are added up. The at most ``local`` codes of largest m are summed in the tasks, the
    others are joined."""
    level = F.floor(F.log2("m") * 8)  # at most 64 * 8 steps of frequency
    least = 0
    room = local
    for r in sorted(values.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            least = r["level"] + 1
            break
    table = values.filter(level >= least).select("code", "value").toArrow()  # at most ``local`` rows
    frequent = d.sparkSession.sparkContext.broadcast(hash_table(table["code"].to_numpy().view(np.uint64), table["value"].to_numpy()))
    parts = d.select(*C.KEYS, "text").mapInArrow(
        _partial_sums(codes_of, frequent), "key_id long not null, key_text long not null, code long, tf long, value double").checkpoint()
    others = (parts.filter("code is not null").drop("value").join(values.filter(level < least).select("code", "value"), "code", "left")
              .select(*C.KEYS, F.col("tf").alias("t"), F.when(F.col("value").isNotNull(), F.col("tf")).otherwise(0).alias("k"),
                      (F.col("tf") * F.coalesce("value", F.lit(unseen))).alias("s")))
    return (parts.filter("code is null").select(*C.KEYS, F.col("tf").alias("t"), F.col("tf").alias("k"), F.col("value").alias("s")).unionByName(others)
            .groupBy(*C.KEYS).agg(F.sum("t").alias("t"), F.sum("k").alias("k"), F.sum("s").alias("s")))


def context_tree_scores(d: DataFrame, depth: int = DEPTH, local: int = LOCAL) -> DataFrame:
    """(key_id, key_text, total): the summed log10 probabilities of the texts of keyed rows with a column training; equal rows are added up."""
    return text_sums(d, lambda texts: runs(texts, depth), run_values(d, depth), 0.0, local).select(*C.KEYS, F.col("s").alias("total"))


def in_training(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offs = C.text_bytes(texts)
    return C.words(C.LOWER[data], offs)


def unigram_sums(d: DataFrame, local: int = LOCAL) -> tuple[DataFrame, int, float, bool]:
    """Of keyed rows with a column training: ``text_sums`` of their words without the end token, the number of training tokens, the end
    token's log10 probability, and whether it is known."""
    counts = (d.filter("training").select("text").mapInArrow(_counts(lambda part: text_words(part.column(0))[0].view(np.int64)), "code long, n long")
              .groupBy("code").agg(F.sum("n").alias("m")).checkpoint())
    total = counts.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = d.filter("training").count()
    tokens, vocabulary = total["n"] + ends, total["v"] + (1 if ends else 0)
    least = math.log10(tokens + vocabulary + 1)
    values = counts.withColumn("value", F.log10(F.col("m").cast("double") + 1) - least)
    return text_sums(d, text_words, values, -least, local), tokens, math.log10(ends + 1) - least, ends > 0


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, local: int = LOCAL) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of each row of ``docs``."""
    d = C.keyed(docs, id_col, text_col).withColumn("training", in_training(F.col("doc_id")))
    scores = context_tree_scores(d, depth, local)
    words, tokens, end_log, end_known = unigram_sums(d, local)
    copies = d.groupBy(*C.KEYS).agg(F.count(F.lit(1)).alias("copies"))  # equal rows have been added up
    each = scores.join(words, C.KEYS).join(copies, C.KEYS).select(
        *C.KEYS, (F.col("total") / F.col("copies")).alias("score"), F.expr("t div copies").alias("n_words"), F.expr("k div copies").alias("n_known"),
        (F.col("s") / F.col("copies")).alias("base_score"))
    out = d.select("doc_id", *C.KEYS, "training", F.octet_length("text").alias("bytes")).join(each, C.KEYS)
    return out.select("doc_id", (~F.col("training")).alias("held_out"), (F.col("n_words") + 1).alias("n_tokens"),
                      (F.col("n_known") + int(end_known)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
                      (F.col("base_score") + end_log).alias("base_score"), "score",
                      (-F.col("score") * math.log2(10) / (F.col("bytes") + 1)).alias("bits_per_byte"))
