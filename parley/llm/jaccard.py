"""Operator 5, n-gram Jaccard join: MinHash banding, then verification on the full n-gram sets.

1. Equal texts are one class; its smallest id stands for it. One row for each class goes on.
2. MinHash signatures of the five-word shingles; ``bands_for`` picks the fewest bands whose chance to share one at the threshold is
   the target recall. Rows are shuffled on band hashes.
3. A bucket (band, hash) with two texts or more is cut into hash blocks of bounded rows and bytes, and each pair of blocks is one
   task's group, so a bucket of any size is spread. Buckets of equal membership in several bands are kept once.
4. In a group, all pairs are compared on their full shingle sets by one matrix product over the shared shingles. A pair counts in
   the first band it shares, so counts add up over groups. What leaves a group is one row for each text: its number of links and the
   smallest text of its linked component there. Pairs are never emitted.
5. Connected components over those rows by min-label propagation with pointer jumping give the classes of near copies.

``near_duplicates`` returns for each row of the input its id, ``class_id`` (the smallest id of its component), ``rep_id`` (the smallest
id with the same text) and ``n_links`` (other distinct texts at or above the threshold). Words are separated by ASCII white space and
compared unchanged; a text of one to four words has one shingle; a text without words (null, empty, blank) has none and links to nothing
but equal texts (null counts as empty). A null id counts as a number below -2**62 made from the text (``node_id``). Repeated rows each return a row.
Links and components run over (smallest id, text hash), so different texts of one id are different documents.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from parley.llm import common as C

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 5
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
HASH_BYTES = 1 << 19  # of text hashed at once
MAX_ROUNDS = 60


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` MinHash values that a pair at the threshold shares one of with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def shingle_hashes(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each shingle occurrence, rows in order."""
    data, offs = C.text_bytes(texts)
    h, row = C.words(data, offs)
    counts = np.bincount(row, minlength=len(texts)) if len(row) else np.zeros(len(texts), np.int64)
    n = len(h) - size + 1
    if n > 0:
        ok = row[:n] == row[size - 1:]
        got, at = C.window_hashes(h, size)[ok], row[:n][ok]
    else:
        got, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.searchsorted(row, np.arange(len(texts)))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        got = np.concatenate([got, C.span_hashes(h, first[short], first[short] + counts[short])])
        at = np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        got, at = got[order], at[order]
    return got, at


def band_hashes(texts: pa.Array, bands: int, rows: int = ROWS) -> np.ndarray:
    """A (texts, bands) array of band hashes; texts without shingles have zeros."""
    h, row = shingle_hashes(texts)
    out = np.zeros((len(texts), bands), np.uint64)
    if not len(h):
        return out
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    owner = row[starts]
    seeds = C.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * C.BASE) | np.uint64(1)
    high = h >> np.uint64(32) ^ h
    for b in range(bands):
        value = np.full(len(starts), b + 1, np.uint64)
        for r in range(rows):
            seed = seeds[b * rows + r]
            x = high * seed
            value = C.mix(value * C.BASE ^ np.minimum.reduceat(x ^ (x >> np.uint64(29)), starts))
        out[owner, b] = value | np.uint64(1)
    return out


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.worker_tables("jaccard")
        for batch in batches:
            for part in C.slices(batch, 1, HASH_BYTES):
                sig = band_hashes(part.column(1), bands, rows)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, bands, dtype=np.int32)), pa.array(sig.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), flat], ["digest", "bands"])
    return run


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each text's different shingles, hashed in pieces of ``HASH_BYTES`` (one text at least)."""
    hashes, rows, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for part in C.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"]), 0, HASH_BYTES):
        h, row = shingle_hashes(part.column(0))
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
        hashes.append(h[new])
        rows.append(row[new] + at)
        at += part.num_rows
    return np.concatenate(hashes), np.concatenate(rows)


def linked(texts: list[str], threshold: float) -> np.ndarray:
    """Boolean matrix of pairs whose shingle sets have Jaccard similarity at or above the threshold."""
    n = len(texts)
    h, row = shingle_sets(texts)
    sizes = np.bincount(row, minlength=n).astype(np.float64)
    _, code, times = np.unique(h, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[shared] = np.arange(len(shared))
    both = np.zeros((n, n))
    for at in range(0, len(shared), 4096):  # shingles in blocks, so that the matrix stays small
        mine = (place[code] >= at) & (place[code] < at + 4096)
        m = np.zeros((n, min(4096, len(shared) - at)), np.float32)
        m[row[mine], place[code[mine]] - at] = 1
        both += m @ m.T
    union = sizes[:, None] + sizes[None, :] - both
    return (both >= threshold * union) & (both > 0) & ~np.eye(n, dtype=bool)


def _compare(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        C.worker_tables("jaccard")
        group = group.drop_duplicates(["rep", "key_text"]).sort_values(["rep", "key_text"]).reset_index(drop=True)
        band, (i, j) = int(group["band"][0]), (int(group["i"][0]), int(group["j"][0]))
        sig = np.stack([np.asarray(x, np.int64) for x in group["bands"]])
        links = linked(group["text"].tolist(), threshold)
        for b in range(band):  # pairs that share an earlier band are counted there
            links &= sig[:, None, b] != sig[None, :, b]
        block = group["block"].to_numpy()
        if i != j:
            links &= block[:, None] != block[None, :]
        rep, key = group["rep"].to_numpy(), group["key_text"].to_numpy()
        label = np.arange(len(rep))
        while True:  # smallest linked position, until nothing moves
            near = np.where(links, label[None, :], len(rep)).min(1)
            new = np.minimum(label, near)
            new = new[new]
            if (new == label).all():
                break
            label = new
        n = links.sum(1)
        return pd.DataFrame({"rep": rep, "key_text": key, "root": rep[label], "root_key": key[label], "n": n})[n > 0]
    return run


def components(edges: DataFrame, a: str = "rep", b: str = "root") -> DataFrame:
    """(node, label): the smallest node of each node's connected component, by min-label propagation with pointer jumping.

    Each round joins on edges and on labels (both splittable), takes minima with partial sums, and is checkpointed."""
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    e = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct().checkpoint()
    labels = e.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("label")).checkpoint()
    for _ in range(MAX_ROUNDS):
        near = (e.join(labels, e["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("m")))
        stepped = labels.join(near, labels["node"] == near["x"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = stepped.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        jumped = (stepped.join(up, stepped["label"] == up["up"], "left")
                  .select("node", "old", F.least("label", F.coalesce("up_label", "label")).alias("label"))).checkpoint()
        labels = jumped.select("node", "label")
        if not jumped.filter("old <> label").take(1):
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def node_id(doc_id: Column, key_text: Column) -> Column:
    """The id as a long; without one, a number below -2**62 made from the text, so that null ids of different texts stay apart."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 62)) - key_text.bitwiseAND(F.lit((1 << 62) - 1)))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key_id, key_text, digest, text): keyed rows with a digest that names the text."""
    d = C.keyed(docs, id_col, text_col)
    return d.withColumn("key_id", node_id(F.col("doc_id"), F.col("key_text"))).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
            rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, digest and keys), and of each different text: digest, node, root (its class's smallest node), n_copies, n_links."""
    bands = bands_for(threshold, recall, rows)
    d = representatives(docs, id_col, text_col)
    members = d.select("doc_id", "key_id", "key_text", "digest", F.octet_length("text").alias("bytes"))
    reps = members.groupBy("digest").agg(F.min("key_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"),
                                         F.first("key_text").alias("key_text"), F.max("bytes").alias("bytes")).checkpoint()
    node = ["rep", "key_text"]
    signed = (d.select("digest", "text").mapInArrow(_signatures(bands, rows), "digest binary, bands array<long>")
              .groupBy("digest").agg(F.first("bands").alias("bands")).join(reps, "digest").select(*node, "bytes", "bands").checkpoint())
    spread = signed.select(*node, "bytes", F.posexplode("bands").alias("band", "hash")).filter("hash <> 0")
    name = F.xxhash64(*node)
    buckets = (spread.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(name).alias("f1"),
                                                  F.bit_xor(F.xxhash64(name, F.lit(7))).alias("f2")).filter("n > 1"))
    buckets = (buckets.groupBy("n", "f1", "f2").agg(F.min(F.struct("band", "hash", "bytes")).alias("b"))
               .select("b.band", "b.hash", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("b.bytes") / BLOCK_BYTES)).cast("int").alias("blocks")))
    asked = spread.select(*node, "band", "hash").join(buckets, ["band", "hash"])
    asked = asked.withColumn("block", F.pmod(F.xxhash64(*node, F.lit(11)), F.col("blocks")).cast("int"))
    asked = asked.select(*node, "band", "hash", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    asked = asked.select(*node, "band", "hash", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    asked = asked.join(signed.select(*node, "bands"), node)
    texts = d.select(F.col("key_id").alias("rep"), "key_text", "text")
    found = (texts.join(asked, node).groupBy("band", "hash", "i", "j")
             .applyInPandas(_compare(threshold), "rep long, key_text long, root long, root_key long, n long").checkpoint())
    links = found.groupBy(*node).agg(F.sum("n").alias("n_links"))
    labels = components(found.select(F.struct(*node).alias("a"), F.struct(F.col("root").alias("rep"), F.col("root_key").alias("key_text")).alias("b")), "a", "b")
    out = (reps.join(links, node, "left").withColumn("node", F.struct(*node)).join(labels, "node", "left")
           .select("digest", "node", F.coalesce("label", "node").alias("root"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return members, out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
                    rows: int = ROWS) -> DataFrame:
    """doc_id, rep_id, class_id, n_copies, n_links of each row of ``docs``."""
    members, out = classes(docs, id_col, text_col, threshold, recall, rows)
    out = out.select("digest", F.col("node.rep").alias("rep_id"), F.col("root.rep").alias("class_id"), "n_copies", "n_links")
    return members.select("doc_id", "digest").join(out, "digest").drop("digest")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Of each class, one row of its smallest (id, text); rows of one id with texts of different classes all stay. Of rows equal in id and
    text but not in other columns, the one with the smallest hash of all columns (but maps) stays."""
    _, out = classes(docs, id_col, text_col, threshold)
    stay = out.filter("node = root").select(F.col("node.rep").alias("__id"), F.col("node.key_text").alias("__text"))
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), node_id(F.col(id_col), text).alias("__id"), text.alias("__text"))
    first = F.min_by("row", F.xxhash64(*[F.col("row")[f.name] for f in docs.schema.fields if not isinstance(f.dataType, MapType)]))
    return rows.join(stay, ["__id", "__text"], "left_semi").groupBy("__id", "__text").agg(first.alias("row")).select("row.*")
