"""Checked queries for the streaming items (ST3, ST4, ST5, ST8)."""
from __future__ import annotations

from pyspark.sql import functions as F

from parley.functions.text import words
from parley.functions.tokenize import CODEPOINT
from parley.plans import fixtures as X
from parley.plans import oracle_views as O
from parley.plans.catalog import register
from parley.plans.queries_corpus import directed_dirty
from parley.session import scratch_path
from parley.sources import files as IO
from parley.streaming import continuous as SC
from parley.streaming import revisions as RV
from parley.streaming import sessions as SS

REVISIONS = 4     # partial revisions per utterance
STABLE_N = 2      # revisions a prefix must survive
TRIGGER_K = 3     # units per firing
CLOSING = "closing"  # session of the row that ends a bounded stream


def partials(spark, d):
    """Revised partial transcripts: revision r of a turn shows the first ceil(r*W/R) words,
    the last of them unstable ('~' appended) until the final revision."""
    c = X.table(spark, d, "conversations")
    x = c.select("conv_id", "turn", words("text").alias("w"), F.explode(F.sequence(F.lit(1), F.lit(REVISIONS))).alias("r"))
    nr = F.ceil(F.col("r") * F.size("w") / REVISIONS).cast("int")
    x = x.withColumn("nr", nr)
    last = F.when(F.col("r") < REVISIONS, F.concat(F.get(F.col("w"), F.col("nr") - 1), F.lit("~"))) \
            .otherwise(F.get(F.col("w"), F.col("nr") - 1))
    text = F.when(F.col("nr") == 0, F.lit("")).otherwise(
        F.array_join(F.concat(F.slice("w", 1, F.col("nr") - 1), F.array(last)), " "))
    return x.select(F.concat_ws("-", "conv_id", "turn").alias("session"),
                    F.timestamp_seconds(F.col("conv_id") * 1000 + F.col("turn") * 20 + F.col("r")).alias("ts"),
                    text.alias("text"))


O.add_view("partials", [], f"""
    SELECT conv_id || '-' || turn AS session, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(conv_id * 1000 + turn * 20 + r)
           AS ts,
           CASE WHEN nr = 0 THEN '' ELSE array_to_string(list_concat(list_slice(w, 1, nr - 1),
                [CASE WHEN r < {REVISIONS} THEN w[nr] || '~' ELSE w[nr] END]), ' ') END AS text
    FROM (SELECT conv_id, turn, w, r, CAST(ceil(r * len(w) / {REVISIONS}) AS INTEGER) AS nr
          FROM (SELECT conv_id, turn, {O.word_list('text')} AS w FROM conversations), range(1, {REVISIONS + 1}) t(r))""")
O.add_view("stable", ["partials"], f"""
    SELECT session, ts, text, stable_len, array_to_string(list_slice(cw, 1, stable_len), ' ') AS stable_text FROM (
        SELECT session, ts, text, cw,
               CAST(coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1),
                                                          lambda i: a[i] = b[i]), false) - 1,
                             least(len(a), len(b))) AS INTEGER) AS stable_len
        FROM (SELECT session, ts, text, cw, lst[1] AS a, lst[len(lst)] AS b FROM (
              SELECT session, ts, text, {O.word_list('text')} AS cw,
                     list({O.word_list('text')}) OVER (PARTITION BY session ORDER BY ts
                                                       ROWS BETWEEN {STABLE_N - 1} PRECEDING AND CURRENT ROW) AS lst
              FROM partials)))""")
O.add_view("fired", ["stable"], f"""
    SELECT session, ts, text, stable_len, stable_text, emitted, emitted > coalesce(lag(emitted) OVER (
               PARTITION BY session ORDER BY ts), 0) AS fire FROM (
        SELECT *, CAST(floor(max(stable_len) OVER (PARTITION BY session ORDER BY ts
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / {TRIGGER_K}) * {TRIGGER_K} AS INTEGER) AS emitted
        FROM stable)""")


def fired(spark, d):
    return RV.trigger_points(RV.stable_prefix(partials(spark, d), STABLE_N), TRIGGER_K)


@register("st3_stable_prefix", O.with_views(["stable"], "SELECT session, ts, stable_len, stable_text FROM stable"))
def st3_stable_prefix(spark, d):
    return RV.stable_prefix(partials(spark, d), STABLE_N).select("session", "ts", "stable_len", "stable_text")


@register("st4_trigger_points", O.with_views(["fired"], "SELECT session, ts, stable_len, emitted, fire FROM fired"))
def st4_trigger_points(spark, d):
    return fired(spark, d).select("session", "ts", "stable_len", "emitted", "fire")


@register("st4_trigger_stream", O.with_views(["fired"], "SELECT session, ts, stable_len, emitted, fire FROM fired"))
def st4_trigger_stream(spark, d):
    """ST3 + ST4 through applyInPandasWithState over a file stream; equals the batch form.

    A bounded input has no later rows to move the watermark past its end, so a closing row does."""
    src = scratch_path(spark, "partials")
    rows = partials(spark, d)
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(F.lit(CLOSING).alias("session"), "ts", F.lit("").alias("text"))
    rows.unionByName(end).write.mode("overwrite").json(src)
    stream = spark.readStream.schema("session string, ts timestamp, text string").json(src)
    out, ck = scratch_path(spark, "st4-out"), scratch_path(spark, "st4-ckpt")
    q = (RV.stable_stream(stream, STABLE_N, TRIGGER_K).writeStream.outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).format("parquet").start(out))
    q.awaitTermination()
    return spark.read.parquet(out).select("session", "ts", "stable_len", "emitted", "fire")


_ST5 = O.with_views(["fired"], """
    SELECT session, min(ts) AS first_partial, min(ts) FILTER (WHERE stable_len > 0) AS first_stable,
           min(ts) FILTER (WHERE fire) AS first_output, max(ts) AS final,
           round(epoch(min(ts) FILTER (WHERE stable_len > 0)) - epoch(min(ts)), 6) AS stable_delay_s,
           round(epoch(min(ts) FILTER (WHERE fire)) - epoch(min(ts)), 6) AS output_delay_s,
           round(epoch(max(ts)) - epoch(min(ts)), 6) AS total_s
    FROM fired GROUP BY session""")


@register("st5_segment_latency", _ST5)
def st5_segment_latency(spark, d):
    return RV.segment_latency(fired(spark, d))


MICRO_BATCHES = 3


def _session_stream(spark, d, form):
    """``form`` over the revisions in shuffled order, dealt into micro-batches. The watermark waits for all of them, and a closing row ends the input."""
    src, out, ck = (scratch_path(spark, f"sessions-{x}") for x in ("src", "out", "ckpt"))
    rows = partials(spark, d)
    days = rows.agg((F.datediff(F.max("ts"), F.min("ts")) + 1).alias("n")).first()["n"] or 1
    end = rows.agg((F.max("ts") + F.make_dt_interval(F.lit(days + 1))).alias("ts")).select(F.lit(CLOSING).alias("session"), "ts", F.lit("").alias("text"))
    files = max(2, spark.sparkContext.defaultParallelism)   # of a micro-batch: its tasks fill the cores
    rows.repartition(MICRO_BATCHES * files, F.xxhash64("session", "ts", "text")).write.json(f"{src}/0")
    end.write.json(f"{src}/1")
    stream = spark.readStream.schema("session string, ts timestamp, text string").option("maxFilesPerTrigger", files).json(f"{src}/*")
    with SS.rocksdb_state(spark):
        q = (form(stream, STABLE_N, TRIGGER_K, watermark=f"{days} days").writeStream.outputMode("append")
             .option("checkpointLocation", ck).trigger(availableNow=True).format("parquet").start(out))
        q.awaitTermination()
    return spark.read.parquet(out).filter(F.col("session") != CLOSING)


@register("st3_session_stream", O.with_views(["fired"], "SELECT session, ts, stable_len, emitted, fire FROM fired"))
def st3_session_stream(spark, d):
    """ST3 + ST4 on the state API, in any order of arrival."""
    return _session_stream(spark, d, SS.stable_sessions)


@register("st5_segment_latency_stream", _ST5)
def st5_segment_latency_stream(spark, d):
    """ST5 as a stream: one row for each session when its time is over."""
    return _session_stream(spark, d, SS.session_latency)


# ------------------------------------------------------------------ ST8
def _continuous(spark, d, job):
    src, out, ck = scratch_path(spark, "st8-src"), scratch_path(spark, "st8-out"), scratch_path(spark, "st8-ckpt")
    IO.write_pairs(directed_dirty(spark, d), src)
    SC.run_continuous(spark, src, out, ck, CODEPOINT, only=[job])
    return SC.latest(spark, f"{out}/{job}")


@register("st8_stream_profile", O.with_views(["flags_dirty"], """
    SELECT direction, count(*) AS n, CAST(coalesce(sum(tlen), 0) AS BIGINT) AS tgt_chars,
           count_if(empty_tgt) AS empty_tgt, count_if(punct_only_tgt) AS punct_only_tgt,
           count_if(ultrashort_tgt) AS ultrashort_tgt, count_if(tgt_not_zh) AS tgt_not_zh,
           count_if(tgt_has_cjk) AS tgt_has_cjk, count_if(src_eq_tgt) AS src_eq_tgt
    FROM flags_dirty GROUP BY direction"""))
def st8_stream_profile(spark, d):
    return _continuous(spark, d, "profile")


@register("st8_stream_token_freq", O.with_views(["directed_dirty"], f"""
    SELECT token_id, count(*) AS freq FROM (
        SELECT unnest({O.codepoints('text')}) AS token_id FROM (
            SELECT src AS text FROM directed_dirty UNION ALL SELECT tgt FROM directed_dirty))
    GROUP BY token_id"""))
def st8_stream_token_freq(spark, d):
    return _continuous(spark, d, "token_freq")
