"""The pipeline on small tables: every stage's decision, nulls, repeated rows, clashing columns, empty tables."""
from __future__ import annotations

import random

import brute
import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq

from parley.llm import common, jaccard


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfg") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n))


LEAK = prose(99, 14)
RANDOM = "".join(random.Random(4).choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))


def tables(folder, rows):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()),
                        ("row", pa.string()), ("host", pa.int32()), ("m", pa.float64()), ("key_text", pa.string())])
    columns = list(zip(*[(i, t, None, "hot", None if t is None else len(t), "r", 1, 0.5, "k") for i, t in rows], strict=True)) or [[]] * 9
    pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema), f"{folder}/documents.parquet")
    pq.write_table(pa.table({"item_id": [1, 2], "text": [LEAK, None]}, pa.schema([("item_id", pa.int64()), ("text", pa.string())])), f"{folder}/benchmark.parquet")


ROWS = [(1, prose(1, 80)), (2, None), (3, ""), (4, "too short"), (5, "spam ham eggs " * 40),
        (6, prose(6, 200)), (7, prose(6, 200) + " extra"), (8, prose(6, 200)), (None, prose(6, 200)),
        (9, prose(9, 40) + " " + LEAK + " " + prose(10, 40)), (10, prose(11, 70) + " password=" + RANDOM + " " + prose(12, 5)),
        (11, prose(13, 60)), (11, prose(13, 60)), (11, prose(14, 60)), (None, prose(15, 60)), (12, prose(16, 30_000))]


def test_every_stage_decides(spark, tmp_path):
    tables(tmp_path, ROWS)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        seen[name] = docs.collect()
        if name != "byte_level_bpe":
            assert docs.columns == columns
        docs = spark.createDataFrame(seen[name], docs.schema)
    ids = {k: sorted((r.doc_id is None, r.doc_id or 0) for r in v) for k, v in seen.items()}
    kept = [i for i in (1, 6, 7, 8, 9, 10, 11, 11, 11, 12)]
    assert ids["quality_rules"] == [(False, i) for i in kept] + [(True, 0)] * 2
    # the copies of 6 include a row without an id, which counts as a number below all ids
    assert len(seen["ngram_jaccard"]) == 8 and {r.text for r in seen["ngram_jaccard"] if r.doc_id is None} == {prose(6, 200), prose(15, 60)}
    assert (False, 9) not in ids["decontamination"] and len(ids["decontamination"]) == 7
    clean = {r.doc_id: r for r in seen["secret_scan"]}
    assert RANDOM not in clean[10].text and "[SECRET]" in clean[10].text and clean[10].n_chars == len(clean[10].text)
    assert {r.text for r in seen["secret_scan"] if r.doc_id == 11} == {prose(13, 60), prose(14, 60)}
    texts = {brute.sha(r.text) for r in seen["secret_scan"]}
    assert {r.decoded_sha256 for r in seen["byte_level_bpe"]} == texts and all(len(r.ids) == r.n_tokens for r in seen["byte_level_bpe"])


def test_run_equals_its_stages_and_takes_empty_tables(spark, tmp_path):
    tables(tmp_path, ROWS)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == 7
    (tmp_path / "none").mkdir()
    tables(tmp_path / "none", [])
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []


def test_tables_of_another_operator_are_dropped_in_a_worker():
    mine = common.worker_tables("one")
    mine["x"] = 1
    assert common.worker_tables("one")["x"] == 1 and "x" not in common.worker_tables("two")


def test_shingle_sets_in_pieces(monkeypatch):
    texts = [prose(i, 30 * i) for i in range(12)] + ["", "a b", prose(3, 90)]
    whole = jaccard.shingle_sets(texts)
    monkeypatch.setattr(jaccard, "HASH_BYTES", 100)
    for a, b in zip(whole, jaccard.shingle_sets(texts), strict=True):
        assert (a == b).all()
    assert jaccard.linked(texts, 0.8)[3, 14]
