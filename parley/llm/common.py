"""Helpers shared by the operators of this subpackage.

Row identity: results are joined back on ``(key_id, key_text)``, the id (null: the smallest long) and
``xxhash64`` of the text, so repeated rows and repeated ids each get their own, equal, answer.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = -(1 << 63)
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key_id, key_text, text): the id as given, the non-null join key, and the text with null as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key_id"),
                       F.xxhash64(text).alias("key_text"), text.alias("text"))


KEYS = ["key_id", "key_text"]


def let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``, so a long expression is not evaluated again for each use."""
    return F.transform(F.array(value), body)[0]


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint for a checkpointed table whose counted size is at most ``max_rows``; beyond it the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches of at most ``rows`` rows for this session's Python functions, so that a worker holds a few MB of text at once
    (and the memory that it keeps between stages stays small). Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- Arrow text to NumPy tokens -------------------------------------------------------------------------------------

_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEPT_POWERS = 1 << 21
_powers: dict[int, np.ndarray] = {}
_kept: dict = {}
_keeper: list[str] = [""]


def worker_tables(operator: str) -> dict:
    """What ``operator`` keeps in this Python worker from one task to the next. Workers are reused by later stages: the tables of another
    operator are dropped when this one's first task starts."""
    if _keeper[0] != operator:
        _kept.clear()
        _powers.clear()
        _keeper[0] = operator
    return _kept


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        m = 1 << max(16, int(n - 1).bit_length())
        have = np.full(m, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if m <= KEPT_POWERS:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, text_index: int, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most ``max_bytes`` together, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(text_index)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows end to end, and the row offsets; null counts as empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offs[0]:offs[-1]], offs - offs[0]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and row numbers of the white-space separated words, with their 64-bit hashes: (hash, row)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ink = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, ink[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, ink[1:]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    row = np.searchsorted(offs, starts, "right") - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n)[starts] + (ends - starts).astype(np.uint64)), row


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values (runs may cross rows; callers mask those)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(BASE, len(h)), out=sums[1:])
    return mix((sums[size:] - sums[:n]) * powers(BASE_INVERSE, n))


def span_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of h[start:end] for each pair."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(BASE, len(h)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, max(1, len(h) + 1))[starts])
