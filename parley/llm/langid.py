"""Operator 13, language ID: averaged hashed subword embeddings with a linear softmax.

1. Texts are lowered; bytes that are neither a-z nor part of a non-ASCII character become spaces. Subwords are the byte 2- to 4-grams
   within a word or at its edge, hashed into ``BUCKETS``.
2. Training rows: of each language at most ``SAMPLE`` different texts, those of the smallest text hash (the bound on what training
   holds); a task turns each into counts of its buckets and one task trains on them: embeddings and softmax by minibatch stochastic
   gradient descent in numpy.
3. One in five of the sample is left out of training and calibrates: a temperature by likelihood, and the rejection level, the
   confidence that all but ``REJECT`` of it reach for their own language.
4. Embeddings and softmax are multiplied out into one weight for each (bucket, language); every whole text is scored in the tasks by
   the mean over its subwords.

``languages`` returns doc_id, held_out, lang_pred, score (calibrated probability of lang_pred) and rejected. Only text and lang of
the rows that are not held out are learnt from; nothing but the text enters a prediction. Null text or text without a letter is
``und`` with score 0, rejected; so is every text if nothing could be learnt. A null id is not held out and not learnt from. Texts
are scored in pieces of ``CHUNK`` bytes, so very long ones need no more memory. Repeated rows are learnt from once and answered each.
Ties of probability go to the language first in byte order. An empty table gives no rows; extra columns take no part.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C
from parley.operators.common import broadcast_if_small, top_n_per_group

BUCKETS = 1 << 14
GRAMS = (2, 3, 4)
DIM = 16
SAMPLE = 800
EPOCHS = 8
BATCH = 32
RATE = 2.0
REJECT = 0.01
CHUNK = 1 << 18
SEED = 20240313

_letter = np.zeros(256, bool)
_letter[97:123] = _letter[128:] = True


def subwords(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, start) of every subword of lowered bytes. Callers put a space on both sides of each text, so none crosses two texts."""
    ink = _letter[data]
    value = np.where(ink, data, 32).astype(np.uint32)
    buckets, starts = [], []
    for size in GRAMS:
        n = len(data) - size + 1
        if n <= 0:
            continue
        code = value[:n].copy()
        ok = ink[:n] | ink[size - 1:]
        for i in range(1, size):
            code = code << np.uint32(8) | value[i:i + n]
            if i < size - 1:
                ok &= ink[i:i + n]
        at = np.flatnonzero(ok)
        x = (code[at].astype(np.uint64) + np.uint64(size << 40)) * C.BASE
        buckets.append((x >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
        starts.append(at)
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(starts)


def chunks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of the bytes that hold the subwords starting in each ``CHUNK`` bytes: (offset, piece and the bytes after it)."""
    for at in range(0, len(data), CHUNK):
        yield at, data[at:at + CHUNK + max(GRAMS) - 1]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, fold, buckets, times) of each training text."""
    for batch in batches:
        for i in range(batch.num_rows):
            data, _ = C.text_bytes(batch.column(0).slice(i, 1))
            total = np.zeros(BUCKETS, np.int64)
            for _, piece in chunks(data):
                b, at = subwords(piece)
                total += np.bincount(b[at < CHUNK], minlength=BUCKETS)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                                              pa.array([total[used].astype(np.int32)], pa.list_(pa.int32()))], ["lang", "fold", "buckets", "times"])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights of BUCKETS x classes, biases): embeddings times softmax weights, by stochastic gradient descent on (buckets, shares) rows."""
    r = np.random.default_rng(SEED)
    emb = (r.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
    out, bias = np.zeros((DIM, classes), np.float32), np.zeros(classes, np.float32)
    steps = EPOCHS * -(-len(rows) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = r.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            x = np.zeros((len(batch), BUCKETS), np.float32)
            for k, i in enumerate(batch):
                x[k, rows[i][0]] = rows[i][1]
            mean = x @ emb
            p = softmax(mean @ out + bias)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            rate = np.float32(RATE * (1 - step / steps))
            back = p @ out.T
            out -= rate * 50 * (mean.T @ p)
            bias -= rate * p.sum(0)
            used = np.flatnonzero(x.any(0))
            emb[used] -= rate * 50 * (x[:, used].T @ back)
            step += 1
    return emb @ out, bias


def calibrate(z: np.ndarray, y: np.ndarray, reject: float = REJECT) -> tuple[float, float]:
    """(temperature of the highest likelihood, confidence that all but ``reject`` of the rows reach for their own class)."""
    if not len(y):
        return 1.0, 0.0
    own = np.arange(len(y))
    temperatures = np.geomspace(0.05, 20, 61)
    loss = [-np.log(softmax(z / t)[own, y] + 1e-300).mean() for t in temperatures]
    t = float(temperatures[int(np.argmin(loss))])
    return t, float(np.quantile(softmax(z / t)[own, y], reject, method="lower"))


def _fit(reject: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True)]
        got.sort(key=lambda x: (x[0], x[1], len(x[2]), x[2].as_py()))
        names = sorted({x[0] for x in got}, key=str.encode)
        rows = []
        for _, _, b, n in got:
            n = n.values.to_numpy().astype(np.float32)
            rows.append((b.values.to_numpy(), n / max(1.0, n.sum())))
        y = np.array([names.index(x[0]) for x in got], np.int64)
        apart = np.array([x[1] % 5 == 0 for x in got], bool)
        seen = np.zeros(len(names), bool)
        seen[y[~apart]] = True
        apart &= seen[y] if len(y) else apart  # a language of calibration rows only is learnt from
        mine = np.flatnonzero(~apart)
        w, bias = train([rows[i] for i in mine], y[mine], len(names)) if names else (np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
        held = np.flatnonzero(apart)
        z = np.stack([rows[i][1] @ w[rows[i][0]] + bias for i in held]) if len(held) else np.zeros((0, len(names)))
        t, level = calibrate(z, y[held], reject)
        yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([w.astype(np.float32).tobytes()], pa.binary()),
                                          pa.array([bias.astype(np.float32).tobytes()], pa.binary()), pa.array([t]), pa.array([level])],
                                         ["names", "weights", "bias", "temperature", "level"])
    return run


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(text), F.lit(" "))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, reject: float = REJECT):
    """A model (names, weights, bias, temperature, level) of the rows with text and lang; held are at most ``sample`` texts of each language."""
    d = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    d = d.filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn("key", F.xxhash64("text", F.lit(SEED)))
    keys = top_n_per_group(d.select("lang", "key").distinct(), ["lang"], ["key"], sample)
    chosen = d.join(broadcast_if_small(keys, 1_000_000), ["lang", "key"], "left_semi").dropDuplicates(["lang", "key"])
    fold = F.pmod(F.xxhash64("key"), F.lit(1000)).cast("int")
    counts = chosen.select(_padded(F.col("text")).alias("text"), "lang", fold.alias("fold")).mapInArrow(
        _counts, "lang string, fold int, buckets array<int>, times array<int>")
    return counts.coalesce(1).mapInArrow(_fit(reject), "names array<string>, weights binary, bias binary, temperature double, level double").first() \
        if keys.take(1) else None


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, bias, temperature, level = model.value
        w = np.frombuffer(weights, np.float32).reshape(BUCKETS, len(names))
        columns = [np.ascontiguousarray(w[:, k]) for k in range(len(names))]
        b = np.frombuffer(bias, np.float32)
        for batch in batches:
            for part in C.slices(batch, 0, CHUNK):
                data, offs = C.text_bytes(part.column(0))
                total, n = np.zeros((len(names), len(part))), np.zeros(len(part))
                for off, piece in chunks(data):
                    bucket, at = subwords(piece)
                    mine = at < CHUNK
                    bucket, row = bucket[mine], np.searchsorted(offs, at[mine] + off, "right") - 1
                    n += np.bincount(row, minlength=len(part))
                    for k, column in enumerate(columns):
                        total[k] += np.bincount(row, column[bucket], minlength=len(part))
                p = softmax(((total / np.maximum(n, 1)).T + b) / temperature)
                best = p.argmax(1)
                score = p[np.arange(len(part)), best]
                letters = part.column(3).to_numpy(zero_copy_only=False)
                lang = pa.array([names[k] if ok else "und" for k, ok in zip(best, letters, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), lang, pa.array(np.where(letters, score, 0.0)),
                                                  pa.array(~letters | (score < level))], ["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def predict(rows: DataFrame, model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of rows (doc_id, held_out, text)."""
    letters = has_letter(F.col("text"))
    if model is None or not model["names"]:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    sent = rows.sparkSession.sparkContext.broadcast((list(model["names"]), bytes(model["weights"]), bytes(model["bias"]), model["temperature"], model["level"]))
    ready = rows.select(F.when(letters, _padded(F.col("text"))).otherwise("").alias("text"), "doc_id", "held_out", letters.alias("letters"))
    return ready.mapInArrow(_predict(sent), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
              reject: float = REJECT) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each row; rows whose crc32 of the id is 2 modulo 4 are held out of learning."""
    left = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(left == 2, F.lit(False)).alias("held_out"), left.alias("left"),
                    F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = fit(d.filter("left <> 2"), sample=sample, reject=reject)
    return predict(d.select("doc_id", "held_out", "text"), model)
