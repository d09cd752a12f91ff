"""Redaction of many, long and overlapping spans, against plain slicing."""
from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from parley.llm import secrets

SPANS = "doc_id long, text string, spans array<struct<start:int,kind_no:int,end:int,match:string>>"


def plain(text, spans, mark):
    out, at = [], 0
    for start, _, end, _ in spans:
        if start >= at:
            out.append(text[at:start])
        at = max(at, end)
    return mark.join([*out, text[at:]]) if spans else text


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 1024, 5000])
def test_replaced_spans_equal_plain_slicing(spark, size):
    r = random.Random(size)
    rows = []
    for i in range(12):
        text = "".join(r.choice("ab \né😀") for _ in range(size))
        cuts = sorted({(a, min(size, a + r.choice([1, 3, 40, 700]))) for a in (r.randrange(size) for _ in range(r.choice([1, 5, 60, 400])))} if size else [])
        rows.append((i, text, [(a, 0, b, "") for a, b in cuts]))
    got = spark.createDataFrame(rows, SPANS).select("doc_id", secrets.replace_spans(F.col("text"), F.col("spans"), "[X]").alias("t")).collect()
    assert {x.doc_id: x.t for x in got} == {i: plain(t, s, "[X]") for i, t, s in rows}


def test_twenty_thousand_spans_in_one_text(spark):
    text = "é " + " ".join(f"token={i:08d}abcdef and" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    start = time.time()
    samples = secrets.corpus_samples(docs)
    assert samples.filter("random").count() == 20_000
    model = secrets.fit(samples)
    got = {x.doc_id: x.text for x in secrets.redact(docs, model).collect()}
    assert got == {1: "é " + " ".join(["[SECRET] and"] * 20_000), 2: None, 3: ""}
    assert time.time() - start < 120  # quadratic work took minutes


def test_redaction_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = secrets.fit(secrets.corpus_samples(docs))
    assert secrets.redact(docs, model).collect() == [] and secrets.scan(docs, model).collect() == []
