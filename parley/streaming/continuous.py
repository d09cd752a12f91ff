"""ST8: continuous token frequency and quality profile with Structured Streaming.

Row-local operators run on a streaming DataFrame as they are (``rowwise``); here the two aggregates are maintained incrementally from a file
source. ``Trigger.AvailableNow`` processes everything present and stops, so
the same job serves scheduled backfills and tests. Aggregate state is keyed
by direction / token id, i.e. bounded by the vocabulary, not the data.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.tokenize import Tokenizer
from parley.operators.profile import METRICS, metric_flags
from parley.operators.vocab import both_sides, token_freq
from parley.sources.files import PAIR_SCHEMA

KEYS = {"profile": ["direction"], "token_freq": ["token_id"]}
JOBS = tuple(KEYS)
BASE, DELTA = "base", "delta"
MAX_DELTAS = 50

def pair_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(PAIR_SCHEMA).option("lineSep", "\n").option("mode", "FAILFAST")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def profile_counts(directed: DataFrame) -> DataFrame:
    """Streaming-safe part of AG2: counters per direction (derived rates are computed at read time)."""
    flags = metric_flags()
    from parley.functions.text import strip_ws
    base = directed.select(F.coalesce("direction", F.lit("?")).alias("direction"),
                           F.length(strip_ws(F.coalesce("tgt", F.lit("")))).alias("_tlen"),
                           *[v.alias(k) for k, v in flags.items()])
    return base.groupBy("direction").agg(F.count(F.lit(1)).alias("n"), F.sum("_tlen").cast("bigint").alias("tgt_chars"),
                                         *[F.count_if(F.col(m)).alias(m) for m in METRICS])


def with_rates(counts: DataFrame) -> DataFrame:
    den = F.greatest(F.lit(1), F.col("n"))
    return counts.select("*", (F.col("tgt_chars") / den).alias("avg_tgt_chars"),
                         *[(F.lit(100.0) * F.col(m) / den).alias(f"pct_{m}") for m in METRICS])


def _merged(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key: the newest base and the deltas after it."""
    t = spark.read.parquet(path)
    base = t.filter(F.col("kind") == BASE).agg(F.max("version")).first()[0]
    if base is None:
        t = t.filter(F.col("kind") == DELTA)
    else:
        t = t.filter(((F.col("kind") == BASE) & (F.col("version") == base)) | ((F.col("kind") == DELTA) & (F.col("version") > base)))
    rest = [c for c in t.columns if c not in (*keys, "kind", "version")]
    newest = t.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_r"))
    return newest.select(*keys, "_r.*")


def _delta_sink(path: str, keys: Sequence[str], max_deltas: int):
    """Writes the keys that a micro-batch changed, with their new values, as a delta of its own; a replayed batch writes the same delta again.

    Deltas become a new base once they hold as many rows as the base (or are ``max_deltas``), so what is written follows the changed keys: each
    changed row is written once, and rewritten by bases of which each is paid for by as many changed rows. Readers go by version and
    meet whole versions only. Older versions stay until ``drop_old``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/kind={DELTA}/version={batch_id}")
        sizes = spark.read.parquet(path).groupBy("kind", "version").agg(F.count(F.lit(1)).alias("n")).collect()  # one row for each version kept
        base = max((r["version"] for r in sizes if r["kind"] == BASE), default=-1)
        held = sum(r["n"] for r in sizes if r["kind"] == BASE and r["version"] == base)
        after = [r["n"] for r in sizes if r["kind"] == DELTA and r["version"] > base]
        if base < batch_id and (sum(after) > held or len(after) >= max_deltas):
            _merged(spark, path, keys).write.mode("overwrite").parquet(f"{path}/kind={BASE}/version={batch_id}")
    return write


def latest(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> DataFrame:
    """The newest complete result under ``path``; ``keys`` are those of the job that the folder is named after, if not given."""
    return _merged(spark, path, keys or KEYS[path.rstrip("/").rsplit("/", 1)[-1]])


def drop_old(spark: SparkSession, path: str) -> int:
    """Deletes the versions under ``path`` that the newest base but one has made superfluous (readers of the newest two bases go on); their number."""
    have = [tuple(r) for r in spark.read.parquet(path).select("kind", "version").distinct().collect()]
    bases = sorted(v for k, v in have if k == BASE)
    if len(bases) < 2:
        return 0
    old = [(k, v) for k, v in have if v < bases[-2] or (k == DELTA and v == bases[-2])]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for k, v in old:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/kind={k}/version={v}")
        p.getFileSystem(conf).delete(p, True)
    return len(old)


def run_continuous(spark: SparkSession, src: str, out: str, checkpoint: str, tok: Tokenizer,
                   available_now: bool = True, only: Sequence[str] = JOBS,
                   max_files_per_trigger: int | None = None, max_deltas: int = MAX_DELTAS) -> dict:
    """Start (and with AvailableNow, finish) the streaming aggregates named in ``only``.

    Each writes the keys that a micro-batch changed as a Parquet delta
    (``foreachBatch``, merged into bases, read by ``latest``); progress lives in ``checkpoint`` (a shared folder), so a
    restarted job resumes from the last committed batch.
    """
    stream = pair_stream(spark, src, max_files_per_trigger)
    jobs = {"profile": lambda: profile_counts(stream), "token_freq": lambda: token_freq(both_sides(stream), tok)}
    handles = {}
    for name in only:
        w = (jobs[name]().writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/{name}")
             .foreachBatch(_delta_sink(f"{out}/{name}", KEYS[name], max_deltas)))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
        handles[name] = w.start()
    if available_now:
        for h in handles.values():
            h.awaitTermination()
    return handles
