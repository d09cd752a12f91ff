"""Deterministic inputs derived from the driver tables.

The driver tables hold no parallel text, so the registered queries build
pairs from ``documents`` lines plus a pseudo-Chinese side. Every view here has
a DuckDB twin in :mod:`parley.plans.oracle_views` with identical rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.common import global_index
from parley.operators.corpus import fan_out

# The 26 lowercase ASCII letters and the 26 CJK characters they map to.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
PSEUDO_CJK = "的一是不了人我在有他这为之大来以个中上们到说国和地也"
# Fixed value: whitespace injected into defect rows (tab, U+3000, U+00A0, space).
INJECTED_WS = "\t\u3000\u00a0 "
# ex_id = doc_id * LINE_BASE + line_no
LINE_BASE = 1 << 32   # a string holds fewer lines than this


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when a scan yields fewer partitions than the
    cluster's parallelism (a single-row-group file); large inputs are left as scanned."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # tasks per core (rows differ in size by orders of magnitude); setting spark.parley.spreadFactor
    factor = int(spark.conf.get("spark.parley.spreadFactor", "2"))
    return df.repartition(factor * cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def next_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, next_id): each vector and the one after it in order of ids, the last one and the first."""
    numbered = global_index(table(spark, sf_dir, "embeddings").select("vec_id"), ["vec_id"], name="at").checkpoint()
    n = numbered.count()
    after = numbered.select(F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("at"), F.col("vec_id").alias("next_id"))
    return numbered.join(after, "at").select("vec_id", "next_id")


def pseudo_zh(en: Column) -> Column:
    return F.translate(F.lower(F.replace(en, F.lit(" "), F.lit(""))), LETTERS, PSEUDO_CJK)


def pairs_clean(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """One row per ``\\n``-separated line of ``documents.text``: (doc_id, line_no, lang, en, zh)."""
    docs = table(spark, sf_dir, "documents")
    keep = ["doc_id", "lang"] + (["source"] if with_source else [])
    lines = docs.select(*keep, F.posexplode(F.split("text", "\n")).alias("line_no", "en"))
    out = ["doc_id", F.col("line_no").cast("int").alias("line_no"), "lang"]
    out += (["source"] if with_source else [])
    return lines.select(*out, "en", pseudo_zh(F.col("en")).alias("zh"))


def inject_defects(df: DataFrame) -> DataFrame:
    """Defects by ``r = (doc_id*31 + line_no) % 23`` (see FIXTURES)."""
    r = (F.col("doc_id") * 31 + F.col("line_no")) % 23
    en, zh = F.col("en"), F.col("zh")
    zh2 = (F.when(r == 0, F.lit("")).when(r == 1, F.lit("...!?")).when(r == 2, en)
           .when(r == 4, F.substring(zh, 1, 1)).when(r == 6, F.repeat(zh, 5))
           .otherwise(zh))
    en2 = (F.when(r == 3, zh)
           .when(r == 5, F.concat(F.lit(INJECTED_WS), en, F.lit(INJECTED_WS), F.lit("x")))
           .otherwise(en))
    cols = [c for c in df.columns if c not in ("en", "zh")]
    return df.select(*cols, en2.alias("en"), zh2.alias("zh"))


def pairs_dirty(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    return inject_defects(pairs_clean(spark, sf_dir, with_source))


def ex_id(doc_id: str = "doc_id", line_no: str = "line_no") -> Column:
    return (F.col(doc_id) * LINE_BASE + F.col(line_no)).alias("ex_id")


def directed(pairs: DataFrame) -> DataFrame:
    """PF5 over an (en, zh) table keeping ``ex_id``: (ex_id, src, tgt, direction)."""
    return fan_out(pairs.select(ex_id(), "en", "zh"), keep=["ex_id"])


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, kind): kind is spoken when the number in the source name is even."""
    docs = table(spark, sf_dir, "documents").select("source").distinct()
    num = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as int)")
    return docs.select("source", F.when(num % 2 == 0, "spoken").otherwise("general").alias("kind"))


def conv_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn joined to the next assistant turn: (conv_id, turn, src, tgt)."""
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("src"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    return u.join(a, ["conv_id", "turn"], "inner")
