"""The registered queries of this subpackage: name -> (builder, DuckDB SQL or None). Each runs over its whole tables."""
from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, collocations, decontaminate, html, jaccard, langid, lm, merkle, quality, secrets, sharding, substring, warc
from parley.llm.common import bound_batches, table
from parley.llm.oracle import SQL


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(secrets.corpus_samples(docs)))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("item_list", ","), 256)).drop("item_list")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("host_rejected")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = bpe.public_vocabulary()
    return bpe.encode_decode(table(spark, sf_dir, "documents"), ranks, pattern, with_ids=False)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "history_pos")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [op1_secret_scan, op2_substring_dedup, op3_decontaminate, op4_quality_rules, op5_ngram_jaccard, op6_bpe, op7_lm_score,
           op8_html_extract, op9_shard, op10_warc, op11_merkle, op12_collocations, op13_language_id, pipeline]


def _bounded(f):
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return f(spark, sf_dir)
    return run


def load() -> dict:
    import corpus_pipeline
    sql = SQL | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {f.__name__: (_bounded(f), sql.get(f.__name__)) for f in QUERIES}
