"""The training-data pipeline: quality rules, near-duplicate removal, benchmark decontamination, secret redaction, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. ``run`` writes each stage's
rows as Parquet into the shared folder of ``spark.checkpoint.dir`` and reads them for the next. Decisions: rows that fail the quality rules go;
one row of each class of near copies (the smallest id and text hash) stays; rows holding a benchmark window go; secrets are replaced by ``[SECRET]`` and ``n_chars``
follows; what is left is encoded and decoded, and the last stage's rows hold the token ids beside the digests.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, common, decontaminate, jaccard, quality, secrets
from parley.session import ensure_checkpoint_dir, scratch_path, ship_package


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    common.bound_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return quality.filter_documents(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    clean = secrets.redact(docs, secrets.fit(secrets.corpus_samples(docs)))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    ranks, pattern = bpe.public_vocabulary()
    return bpe.encode_decode(docs, ranks, pattern, with_decoded=False)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("decontamination", benchmark_decontamination),
          ("secret_scan", secret_scan), ("byte_level_bpe", byte_level_bpe)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = common.table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
