"""Row-local operators on a stream: encode, map, assemble, export and decode (SQ1-SQ9) need no state and no regrouping.

``map_stream`` is any such operator between a file source and an append-only Parquet sink; ``through_stream`` replays a bounded table
through it in micro-batches, for backfills and for the registered queries.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from parley.session import scratch_path


def map_stream(stream: DataFrame, form: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start ``form`` over ``stream`` into the Parquet folder ``out``; progress lives in ``checkpoint`` (a shared folder)."""
    w = form(stream).writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out)


def through_stream(rows: DataFrame, form: Callable[[DataFrame], DataFrame], name: str, files_per_batch: int | None = None) -> tuple[DataFrame, int]:
    """(result, number of micro-batches) of ``form`` over ``rows``, written as files and read as a stream.

    A micro-batch takes ``files_per_batch`` files; without it two for each core, so that its tasks fill the cluster."""
    spark = rows.sparkSession
    files_per_batch = files_per_batch or 2 * spark.sparkContext.defaultParallelism
    src = scratch_path(spark, f"{name}-src")
    rows.write.parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(src)
    out = scratch_path(spark, f"{name}-out")
    q = map_stream(stream, form, out, scratch_path(spark, f"{name}-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out), sum(p["numInputRows"] > 0 for p in q.recentProgress)
