"""Plan-shape helpers shared by the operators.

* ``top_n_per_group``: first n rows per group through ``row_number() <= n`` so
  Catalyst plans a partial ``WindowGroupLimit`` before the shuffle; a tree
  of salted levels bounds the rows of a hot group in one task.
* ``global_index``: 0-based position in a total order without a single-partition
  window (range partitioning + per-partition offsets).
* ``broadcast_if_small``: broadcast only after rows and bytes have been counted.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

FAN_IN = 16
MAX_BROADCAST_BYTES = 128 << 20


def bound_batches(spark: SparkSession, rows: int) -> None:
    """Arrow batches of at most ``rows`` rows for this session's Python functions. Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n_per_group(df: DataFrame, keys: Sequence, order: Sequence, n: int,
                    rank_col: str | None = None, salt_buckets: int | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each group by ``order`` (a total order).

    A tree of salted levels comes first: each keeps the first ``n`` of every (group, hash bucket), with
    ``FAN_IN`` times fewer buckets at the next one, down to the group itself. Buckets below the first level
    take in ``FAN_IN`` buckets each, so one task gets at most ``n * FAN_IN`` rows of a group, however large
    it is. ``salt_buckets`` is the first level's count (default: the shuffle partitions; 0 or 1: no salt).
    """
    keys_c, order_c = _cols(keys), _cols(order)
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if salt_buckets is None else salt_buckets
    if buckets > 1:
        # salt from the row content (deterministic on re-execution); map columns cannot be hashed
        hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)]
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*hashable), F.lit(buckets)))
        while buckets > 1:
            w = W.partitionBy(*keys_c, "__salt").orderBy(*order_c)
            df = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
            df = df.withColumn("__salt", F.floor(F.col("__salt") / FAN_IN))
            buckets = -(-buckets // FAN_IN)
        df = df.drop("__salt")
    w = W.partitionBy(*keys_c).orderBy(*order_c)
    rc = rank_col or "__rn"
    out = df.withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n)
    return out if rank_col else out.drop(rc)


def global_index(df: DataFrame, order: Sequence, name: str = "idx", start: int = 0,
                 partitions: int | None = None, running_sum: str | None = None,
                 running_name: str = "running", total_name: str | None = None, compute_once: bool = False) -> DataFrame:
    """Add the 0-based (plus ``start``) position of every row in ``order``.

    Range-partition by the order, sort within partitions, number rows inside
    each partition, then add the row count of all lower partitions (a table
    with one row per partition, broadcast). The numbered table is
    checkpointed so both uses see the same partitions even if recomputed.

    The range partitioner reads its input twice, once for its sample of the order. ``compute_once`` holds the rows on the
    executors' disks meanwhile, for input that is dear to compute and narrow.
    """
    order_c = _cols(order)
    if compute_once:
        df = df.persist(StorageLevel.DISK_ONLY)
    s = df.repartitionByRange(partitions, *order_c) if partitions else df.repartitionByRange(*order_c)
    s = s.sortWithinPartitions(*order_c).withColumn("__mid", F.monotonically_increasing_id())
    s = s.withColumn("__pid", F.shiftright("__mid", 33))
    s = s.withColumn("__loc", F.col("__mid") - F.shiftleft(F.col("__pid"), 33)).drop("__mid")
    s = s.checkpoint(eager=True)
    if compute_once:
        df.unpersist()
    aggs = [F.count(F.lit(1)).alias("__n")]
    if running_sum:
        aggs.append(F.sum(running_sum).alias("__s"))
    counts = s.groupBy("__pid").agg(*aggs)
    before = W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")]
    if running_sum:
        offs.append(F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__soff"))
        offs.append(F.sum("__s").over(W.partitionBy()).alias(total_name or "__stot"))
    offs = counts.select("__pid", *offs)  # one row per partition
    out = s.join(F.broadcast(offs), "__pid").withColumn(
        name, F.col("__off") + F.col("__loc") + F.lit(start))
    if running_sum:
        # rows of one partition are one group of the range partitioning: bounded size
        local = W.partitionBy("__pid").orderBy("__loc").rowsBetween(W.unboundedPreceding, 0)
        out = out.withColumn(running_name, F.col("__soff") + F.sum(running_sum).over(local)).drop("__soff")
        if not total_name:
            out = out.drop("__stot")
    return out.drop("__pid", "__loc", "__off")


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 for a number, the length of strings, and the JSON length of anything nested."""
    def one(f) -> Column:
        if isinstance(f.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(f.name), F.lit(0))
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        return F.lit(8)
    return sum((one(f) for f in df.schema.fields), F.lit(0)).cast("long")


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table holds at most ``max_rows`` rows and ``max_bytes`` bytes: one aggregate with partial sums."""
    size = df.select(_row_bytes(df).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the table is proven to hold at most ``max_rows`` rows and ``max_bytes`` bytes.

    Beyond the bounds the join shuffles, with the same results."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
