"""Operator 2, substring dedup: compacted De Bruijn paths over word k-mers, joined in Spark.

* Edges. Every window of ``window`` words picks its smallest-hashed ``k``-mer (the leftmost of ties) as its anchor edge, so
  equal windows pick equal edges wherever they stand, and one edge in about 22 words is kept.
* Paths. All windows of one anchor occurrence lie in one stretch of words, the path around that edge. Occurrences of an edge
  whose paths are equal are one nonbranching path: its windows belong to the same documents, and one row stands for all of them.
  Occurrences that differ are a branch; there, one occurrence of each path emits its windows, and these are joined one by one.
* Source coordinates. Each path row carries document and word positions; covered words are the union of the proven stretches.

A window is removed where its word sequence also starts in a document with a smaller id. Words are separated by
ASCII white space. Null or empty text has no words; a text of fewer than ``window`` words loses none. Null ids count as the
smallest id and as one document; rows of equal id are one document as well, so they never remove each other. Repeated rows each
return a row. Word sequences are compared by two 64-bit hashes together (edge and path, or edge and window).

Only the edges (about 1/22 of the words) are shuffled, first as partial minima; the text is shuffled by document key for the join
with the found spans. A passage held by a third of all documents is one partial minimum per task, and its occurrences meet
in a join that adaptive execution can split.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C

WINDOW = 50
K = 8


def leftmost_minimum(x: np.ndarray, size: int) -> np.ndarray:
    """For each run of ``size`` values the position of the smallest, the leftmost of ties, by doubling runs."""
    n = len(x) - size + 1
    at, width = np.arange(len(x)), 1
    while width < size:
        step = min(width, size - width)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(x[right] < x[left], right, left)
        width += step
    return at[:max(0, n)]


def anchor_paths(h: np.ndarray, row: np.ndarray, window: int = WINDOW, k: int = K):
    """Anchor occurrences of the given word hashes: edge hash, path hash, row, first and last window start."""
    n = len(h) - window + 1
    if n <= 0:
        z = np.zeros(0, np.uint64)
        return z, z, z.astype(np.int64), z.astype(np.int64), z.astype(np.int64)
    edges = C.window_hashes(h, k)
    at = leftmost_minimum(edges, window - k + 1)
    starts = np.flatnonzero(row[:n] == row[window - 1:])
    q = at[starts]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (row[starts[1:]] != row[starts[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(q)) - 1
    lo, hi, q = starts[first], starts[last], q[first]
    path = C.span_hashes(h, lo, hi + window) ^ C.mix((q - lo).astype(np.uint64) << np.uint64(20) | (hi - q + window).astype(np.uint64))
    return edges[q], path, row[lo], lo, hi


def _first_word(row: np.ndarray, rows: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(rows))


def _edges(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2):
                data, offs = C.text_bytes(part.column(2))
                h, row = C.words(data, offs)
                edge, path, r, lo, hi = anchor_paths(h, row, window, k)
                base = _first_word(row, part.num_rows)[r] if len(r) else r
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edge.view(np.int64)), pa.array(path.view(np.int64)), part.column(0).take(pa.array(r)), part.column(1).take(pa.array(r)),
                     pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32))],
                    ["edge", "path", "key_id", "key_text", "lo", "hi"])
    return run


def _branch_windows(window: int):
    """Windows of the asked path occurrences: one row for each, with its hash and start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, 2):
                data, offs = C.text_bytes(part.column(2))
                h, row = C.words(data, offs)
                hashes = C.window_hashes(h, window)
                first = _first_word(row, part.num_rows)
                out_row, out_edge, out_at = [], [], []
                for i, asked in enumerate(part.column(3).to_pylist()):
                    for x in asked:
                        at = np.arange(first[i] + x["lo"], first[i] + x["hi"] + 1)
                        out_at.append(at)
                        out_row.append(np.full(len(at), i))
                        out_edge.append(np.full(len(at), x["edge"], np.int64))
                if not out_at:
                    continue
                at, r = np.concatenate(out_at), np.concatenate(out_row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_edge)), pa.array(hashes[at].view(np.int64)), part.column(0).take(pa.array(r)),
                     part.column(1).take(pa.array(r)), pa.array((at - first[r]).astype(np.int32))],
                    ["edge", "hash", "key_id", "key_text", "lo"])
    return run


def _cut(with_text: bool):
    """(text, spans) to counts and digest of the kept words, and with ``with_text`` the kept text itself."""
    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, found in zip(text, spans, strict=True):
            w = t.encode().split()
            kept = w
            if found is not None and len(found):
                covered = np.zeros(len(w) + 1, np.int64)
                for s in found:
                    covered[s["lo"]] += 1
                    covered[s["hi"]] -= 1
                kept = [w[i] for i in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]
            joined = b" ".join(kept)
            out.append((len(w), len(w) - len(kept), hashlib.sha256(joined).hexdigest(), *[joined.decode()] * with_text))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept_text"][:3 + with_text])
    return cut


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """(key_id, key_text, lo, hi): stretches of words, end exclusive, covered by windows that also start in a smaller document."""
    return _spans(_by_document(docs, id_col, text_col), C.keyed(docs, id_col, text_col).drop("doc_id"), window, k)


def _by_document(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key_id, key_text, text) by key: one plan for every use, so that its shuffle of the texts is written once and reused."""
    return C.keyed(docs, id_col, text_col).drop("doc_id").repartition(C.partitions(docs.sparkSession), *C.KEYS)


def _spans(by_doc: DataFrame, d: DataFrame, window: int, k: int) -> DataFrame:
    edges = d.mapInArrow(_edges(window, k), "edge long not null, path long not null, key_id long not null, key_text long not null, lo int, hi int")
    repeated = (edges.groupBy("edge").agg(F.min("key_id").alias("a"), F.max("key_id").alias("b"), F.min("path").alias("p"), F.max("path").alias("q"))
                .filter("a < b").select("edge", F.col("a").alias("owner"), (F.col("p") != F.col("q")).alias("branches")))
    found = edges.join(repeated, "edge").checkpoint()
    ends = (F.col("hi") + window).alias("hi")
    plain = found.filter("not branches and key_id > owner").select(*C.KEYS, "lo", ends)
    branching = found.filter("branches")
    paths = branching.groupBy("edge", "path").agg(F.min("key_id").alias("first"))
    branching = branching.join(paths, ["edge", "path"])
    whole = branching.filter("key_id > first").select(*C.KEYS, "lo", ends)
    asked = (branching.filter("key_id = first").groupBy(*C.KEYS)
             .agg(F.collect_list(F.struct("edge", "lo", "hi")).alias("asked")))
    windows = (by_doc.join(asked, C.KEYS).select(*C.KEYS, "text", "asked").mapInArrow(
        _branch_windows(window), "edge long, hash long, key_id long not null, key_text long not null, lo int"))
    owners = windows.groupBy("edge", "hash").agg(F.min("key_id").alias("a"), F.max("key_id").alias("b")).filter("a < b")
    single = (windows.join(owners, ["edge", "hash"]).filter("key_id > a")
              .select(*C.KEYS, "lo", (F.col("lo") + window).alias("hi")))
    return plain.unionByName(whole).unionByName(single)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K,
                    with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``, kept_text for each row of ``docs``."""
    by_doc = _by_document(docs, id_col, text_col)
    spans = _spans(by_doc, C.keyed(docs, id_col, text_col).drop("doc_id"), window, k).groupBy(*C.KEYS).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    cut = by_doc.join(spans, C.KEYS, "left").select(F.nullif("key_id", F.lit(C.NULL_ID)).alias("doc_id"), _cut(with_text)("text", "spans").alias("r"))
    return cut.select("doc_id", "r.*")
