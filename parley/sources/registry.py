"""Source registry (IO5) with failure-tolerant loading (IO6).

A source is (sid, loader, schema tag, kind). Each loader returns a DataFrame
(usually ``spark.read.format(fmt).load(path)``); a loader that fails while
resolving its schema is reported as ``skip`` and the others continue. The
adapted sources are combined with ``unionByName`` (SO5).
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.corpus import adapt_source


@dataclass(frozen=True)
class SourceSpec:
    sid: str
    loader: Callable[[], DataFrame]
    schema: str          # "translation" | "st_pair" | other (adapts to empty strings)
    kind: str            # e.g. "spoken" | "general"


def file_source(spark: SparkSession, sid: str, path: str, fmt: str, schema: str, kind: str,
                **options) -> SourceSpec:
    return SourceSpec(sid, lambda: spark.read.format(fmt).options(**options).load(path), schema, kind)


def load_sources(specs: Sequence[SourceSpec], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Adapt and union every loadable source.

    Returns (rows, status): rows = (sid, kind, *keep, en, zh); status =
    (source, kind, status, rows) with per-source row counts from one
    ``groupBy`` over the union and 0 for skipped sources.
    """
    frames, meta, spark = [], [], None
    for s in specs:
        try:
            df = s.loader()
            spark = df.sparkSession
            adapted = adapt_source(df, s.schema, keep=list(keep))
            frames.append(adapted.select(F.lit(s.sid).alias("sid"), F.lit(s.kind).alias("kind"),
                                         *adapted.columns))
            meta.append((s.sid, s.kind, "ok"))
        except Exception as e:  # any failure of one source leaves the others
            meta.append((s.sid, s.kind, "skip"))
            print(f"[skip] {s.sid} ({s.kind}): {type(e).__name__}")
    if not frames:
        raise RuntimeError("no source could be loaded")
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    counts = rows.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    specs_df = spark.createDataFrame(meta, "sid string, kind string, status string")
    status = specs_df.join(F.broadcast(counts), "sid", "left").select(
        F.col("sid").alias("source"), "kind", "status", F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"))
    return rows, status


def require_rows(status: DataFrame) -> int:
    """Zero accepted rows over all sources is an error (IO6)."""
    total = status.agg(F.sum("rows")).first()[0] or 0
    if total == 0:
        raise RuntimeError("no rows from any source")
    return int(total)
