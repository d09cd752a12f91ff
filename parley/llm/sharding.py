"""Operator 9, sharding by a Feistel permutation of global row numbers (law ``rows``).

Rows are numbered 0 to N-1 in the order of id and text hash: a range partitioning, local numbers, and the counts of the lower
partitions. A keyed balanced Feistel network permutes the smallest even-bit domain that holds N; values at or over N walk the
cycle until they fall below it, which keeps it a permutation of 0 to N-1. Place p goes to shard p mod S, slot p // S, so
counts differ by one at most, slots have no gaps, and anyone who knows N, S, the seed and a row number can compute its place.

Null text has size 1 and the crc of the empty text; null ids sort first. Rows equal in id and text are interchangeable and
get places of their own. Only ids, sizes and hashes move, never texts. Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C
from parley.operators.common import global_index

SHARDS = 8
SEED = 20240229
ROUNDS = 6


def feistel(x: np.ndarray, half: int, seed: int) -> np.ndarray:
    """A permutation of 0 .. 4**half - 1."""
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for r in range(ROUNDS):
        key = np.uint64((seed * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) % (1 << 64))
        left, right = right, left ^ (C.mix(right ^ key) & mask)
    return left << np.uint64(half) | right


def permute(x: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number below ``n``, by cycle walking."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    out = feistel(x.astype(np.uint64), half, seed)
    while (far := out >= np.uint64(n)).any():
        out[far] = feistel(out[far], half, seed)
    return out


def _places(n: int, shards: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = permute(b.column(3).to_numpy(zero_copy_only=False), n, seed)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array((place % np.uint64(shards)).astype(np.int32)),
                                              pa.array((place // np.uint64(shards)).astype(np.int64))], ["doc_id", "size", "text_crc32", "row_number", "shard", "slot"])
    return run


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of each row of ``docs``."""
    d = C.keyed(docs, id_col, text_col).select(
        "doc_id", *C.KEYS, (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    numbered = global_index(d, [*C.KEYS], name="row_number").select("doc_id", "size", "text_crc32", F.col("row_number").cast("long"))
    n = numbered.count()
    return numbered.mapInArrow(_places(n, shards, seed), "doc_id long, size long, text_crc32 long, row_number long, shard int, slot long")
