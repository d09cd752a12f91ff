"""File sources and sinks (IO1-IO4, IO7, IO8, IO12, IO13).

Schemas are explicit (never inferred); JSON is read line by line with
``lineSep='\\n'`` and FAILFAST unless asked otherwise.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.text import strip_ws

PAIR_SCHEMA = T.StructType([T.StructField("src", T.StringType()), T.StructField("tgt", T.StringType()),
                            T.StructField("direction", T.StringType())])
EVAL_SCHEMA = T.StructType([T.StructField("direction", T.StringType()), T.StructField("src", T.StringType()),
                            T.StructField("hyp", T.StringType()), T.StructField("ref", T.StringType()),
                            T.StructField("gen_tok", T.IntegerType())])


# ---------------------------------------------------------------- IO1 / IO2
def read_pairs(spark: SparkSession, path: str, mode: str = "FAILFAST",
               schema: T.StructType = PAIR_SCHEMA) -> DataFrame:
    """IO1: pair JSONL with an explicit schema; blank lines are skipped.

    ``mode='PERMISSIVE'`` keeps malformed lines in ``_corrupt_record`` instead of failing.
    """
    r = spark.read.option("lineSep", "\n").option("mode", mode)
    if mode == "PERMISSIVE":
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        r = r.option("columnNameOfCorruptRecord", "_corrupt_record")
    return r.schema(schema).json(path)


def write_pairs(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """IO2: pair JSONL, UTF-8 text written as is (no escaping of non-ASCII). Files are compressed (``none``: plain), each as a whole, so one
    task reads a file, as one wrote it."""
    df.select("src", "tgt", "direction").write.mode(mode).option("lineSep", "\n").option("compression", compression).json(path)


# ---------------------------------------------------------------- IO3 / IO4
def read_segments(spark: SparkSession, path: str, by: str | None = None) -> DataFrame:
    """IO3: one segment per line, stripped, blank lines dropped; with ``by``, the folders of that
    partition column are found by one scan and give its value."""
    r = spark.read.option("lineSep", "\n")
    t = r.schema(f"value string, {by} string").text(path) if by else r.text(path)
    return t.select(*([by] if by else []), strip_ws("value").alias("segment")).filter(F.length("segment") > 0)


def write_segments(df: DataFrame, path: str, by: str | None = "lang", mode: str = "overwrite") -> None:
    """IO4: segments as text lines, one folder per language."""
    w = df.select(*([by] if by else []), "segment").write.mode(mode)
    (w.partitionBy(by) if by else w).text(path)


# ---------------------------------------------------------------- IO7 / IO8
def read_vocab_map(spark: SparkSession, path: str) -> DataFrame:
    """IO7: JSON object {"old_id": new_id, ...} (string keys) -> (old_id int, new_id int).

    The object is one JSON document, so it is read whole; its size is bounded
    by the tokenizer's id space.
    """
    t = spark.read.text(path, wholetext=True)
    m = t.select(F.explode(F.from_json("value", "map<string,int>")).alias("k", "new_id"))
    return m.select(F.col("k").cast("int").alias("old_id"), F.col("new_id").cast("int").alias("new_id"))


def write_vocab_map(vmap: DataFrame, path: str, json_path: str | None = None) -> None:
    """IO8: the map as Parquet; optionally also the JSON export form (one object, string keys, by id).

    The JSON form is one document by its format, so one row holds the id space, as in ``read_vocab_map``."""
    vmap.select("old_id", "new_id").write.mode("overwrite").parquet(path)
    if json_path:
        entries = F.array_sort(F.collect_list(F.struct("old_id", "new_id")))
        obj = vmap.agg(F.to_json(F.map_from_entries(F.transform(
            entries, lambda e: F.struct(e["old_id"].cast("string"), e["new_id"])))).alias("value"))
        obj.coalesce(1).write.mode("overwrite").text(json_path)


# ---------------------------------------------------------------- IO12 / IO13
def write_eval_jsonl(records: DataFrame, summary: DataFrame, path: str) -> None:
    """IO12: evaluation records as JSONL, then the summary appended as a {"summary": ...} row."""
    cols = [c.name for c in EVAL_SCHEMA.fields]
    records.select(F.to_json(F.struct(*cols)).alias("value")).write.mode("overwrite").text(path)
    s = summary.agg(F.to_json(F.struct(F.collect_list(F.struct(*summary.columns)).alias("summary"))).alias("value"))
    s.coalesce(1).write.mode("append").text(path)


def read_eval_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """IO13: records of an evaluation JSONL; blank lines and rows having a ``summary`` key are skipped
    (key presence, so {"summary": null} is skipped too). ``ex_id`` numbers the rows of the scan, so repeated
    records keep keys of their own."""
    t = spark.read.option("lineSep", "\n").text(path).filter(F.length(F.trim("value")) > 0)
    t = t.filter(~F.coalesce(F.array_contains(F.json_object_keys("value"), "summary"), F.lit(False)))
    r = t.select(F.from_json("value", EVAL_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return r.withColumn("ex_id", F.monotonically_increasing_id())
