"""A registered Python data source over folders of Parquet shards (IO5, IO9): ``spark.read.format("parley_shards")``.

* Batch read: one partition for each shard file, read in Arrow batches. Comparisons with literals on integer, string and boolean columns are pushed
  into the Parquet scan (``spark.sql.python.filterPushdown.enabled``), a given schema prunes columns, ``limit`` ends a shard after that many
  rows that pass the pushed filters, ``shards`` names the folders and the range of shards to read: ``{"folder": [first, last + 1]}``, and ``folder``
  names a column for the folder of each row.
* Stream read: offsets are shard names; a micro-batch holds the shards whose names sort after the last one read (at most ``maxShards``).
* Write: each run of equal ``shard_id`` in a task becomes one file, and the commit messages become the manifest. Readers see only the files that the
  manifest names, so shards and manifest appear together; a failed job takes its files back. The rows come in by ``write_committed``.

``read_until_quota`` reads sources in waves of shards and stops each one when its quota of accepted rows is filled.

Shards are opened through ``pyarrow.fs``, so the path is a local (shared) folder or a URI that pyarrow knows. Null values, empty tables and empty folders
are read as such; a folder without shards needs a schema.
"""
from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage)

FORMAT = "parley_shards"
MANIFEST = "manifest.parquet"
BATCH_ROWS = 4_096
PUSHED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType)


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def in_order(name: str) -> str:
    """Sort key of a shard's name: numbers count as numbers."""
    return re.sub(r"\d+", lambda m: m[0].zfill(20), name)


def shard_files(path: str, folder: str = "") -> list[str]:
    """Names of the shards of a folder, relative to ``path``: those of its manifest, or else its Parquet files by name."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    store, root = _open(path)
    base = f"{root}/{folder}".rstrip("/")
    prefix = f"{folder}/" if folder else ""
    if store.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.File:
        rows = pq.read_table(f"{base}/{MANIFEST}", filesystem=store, columns=["file"]).column("file").to_pylist()
        return [prefix + name for name in rows]
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    names = [f.base_name for f in found if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and f.base_name[0] not in "_."]
    return sorted((prefix + n for n in names if n != MANIFEST), key=in_order)


def without(schema: T.StructType, column: str | None) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != column])


class Shard(InputPartition):
    def __init__(self, file: str):
        self.file = file


def _expression(f: Filter, schema: T.StructType):
    """The filter for the Parquet scan, or None where it stays with Spark."""
    import pyarrow.compute as pc
    name = f.attribute[0]
    if len(f.attribute) != 1 or name not in schema.names or not isinstance(schema[name].dataType, PUSHED_TYPES):
        return None
    col = pc.field(name)
    if isinstance(f, IsNotNull):
        return col.is_valid()
    if isinstance(f, IsNull):
        return col.is_null()
    if isinstance(f, In):
        return col.isin([x for x in f.value if x is not None])
    compare = {EqualTo: "__eq__", GreaterThan: "__gt__", GreaterThanOrEqual: "__ge__", LessThan: "__lt__", LessThanOrEqual: "__le__"}.get(type(f))
    return getattr(col, compare)(f.value) if compare and f.value is not None else None


def _read(path: str, file: str, schema: T.StructType, filters: Sequence[Filter] = (), limit: int | None = None, folder: str | None = None) -> Iterator:
    import pyarrow as pa
    import pyarrow.dataset as ds
    from pyspark.sql.pandas.types import to_arrow_schema
    store, root = _open(path)
    stored = without(schema, folder)
    target, result = to_arrow_schema(stored), to_arrow_schema(schema)
    keep = None
    for f in filters:
        part = _expression(f, stored)
        keep = part if keep is None else keep & part
    data = ds.dataset(f"{root}/{file}", filesystem=store, format="parquet")
    left = limit
    for batch in data.to_batches(columns=stored.names, filter=keep, batch_size=BATCH_ROWS):
        if left is not None:
            batch = batch.slice(0, left)
            left -= batch.num_rows
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).cast(target)
            if folder:
                table = table.append_column(folder, pa.array([file.rpartition("/")[0]] * table.num_rows, pa.string())).select(schema.names).cast(result)
            yield from table.to_batches()
        if left == 0:
            return


class ShardReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.limit = int(options["limit"]) if "limit" in options else None
        self.ranges = json.loads(options["shards"]) if "shards" in options else None
        self.folder = options.get("folder")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if hasattr(f, "attribute") and _expression(f, without(self.schema, self.folder)) is not None:
                self.filters.append(f)
            elif self.limit is not None:
                raise ValueError("a limit for each shard needs filters that can be pushed down")
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        if self.ranges is None:
            return [Shard(f) for f in shard_files(self.path)]
        return [Shard(f) for folder, (first, end) in sorted(self.ranges.items()) for f in shard_files(self.path, folder)[first:end]]

    def read(self, partition: Shard | None) -> Iterator:
        if partition is None:  # no shards
            return iter(())
        return _read(self.path, partition.file, self.schema, self.filters, self.limit, self.folder)


class ShardStreamReader(DataSourceStreamReader):
    """Offsets are {"after": name of the last shard read}. New shards must sort after those there before."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.most = int(options.get("maxshards", options.get("maxShards", 1_000)))
        self.after = ""

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        new = [f for f in shard_files(self.path) if in_order(f) > in_order(self.after)][:self.most]
        self.after = new[-1] if new else self.after
        return {"after": self.after}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.after = max(self.after, end["after"], key=in_order)
        return [Shard(f) for f in shard_files(self.path) if in_order(start["after"]) < in_order(f) <= in_order(end["after"])]

    def read(self, partition: Shard) -> Iterator:
        return _read(self.path, partition.file, self.schema)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    shards: list[tuple[int, str, int]]  # shard_id, file, rows


class ShardWriter(DataSourceArrowWriter):
    """One file for each run of equal ``shard_id``; the manifest is written last, from the commit messages."""

    def __init__(self, options: dict[str, str]):
        self.path, self.job = options["path"], uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator) -> Written:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        done: list[tuple[int, str, int]] = []
        files: list[str] = []
        sink, current, rows = None, None, 0
        try:
            for batch in iterator:
                ids = batch.column("shard_id")
                at = 0
                while at < batch.num_rows:
                    shard = ids[at].as_py()
                    same = pc.equal(ids.slice(at), shard)
                    first_other = pc.index(same, False).as_py()
                    end = batch.num_rows if first_other < 0 else at + first_other
                    if shard != current:
                        if sink:
                            sink.close()
                            done.append((current, files[-1], rows))
                        files.append(f"shard-{shard:08d}-{self.job}-{uuid.uuid4().hex[:8]}.parquet")
                        sink, current, rows = pq.ParquetWriter(f"{root}/{files[-1]}", batch.schema, filesystem=store), shard, 0
                    sink.write_table(pa.Table.from_batches([batch.slice(at, end - at)]))
                    rows += end - at
                    at = end
            if sink:
                sink.close()
                done.append((current, files[-1], rows))
        except BaseException:
            if sink:
                sink.close()
            for f in files:
                store.delete_file(f"{root}/{f}")
            raise
        return Written(done)

    def _own_files(self) -> list[str]:
        from pyarrow import fs
        store, root = _open(self.path)
        return [f.base_name for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f"-{self.job}-" in f.base_name]

    def commit(self, messages: list[Written | None]) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq
        store, root = _open(self.path)
        shards = sorted(s for m in messages if m is not None for s in m.shards)
        ids = [s[0] for s in shards]
        if len(set(ids)) != len(ids):
            self.abort(messages)
            raise ValueError("a shard was written by more than one task: partition and sort the rows by shard_id")
        ends, total = [], 0
        for _, _, n in shards:
            total += n
            ends.append(total)
        table = pa.table({"shard_id": pa.array(ids, pa.int32()), "n": pa.array([s[2] for s in shards], pa.int64()),
                          "start": pa.array([e - s[2] for e, s in zip(ends, shards, strict=True)], pa.int64()), "end": pa.array(ends, pa.int64()),
                          "file": pa.array([s[1] for s in shards], pa.string())})
        kept = {s[1] for s in shards}
        for f in self._own_files():  # attempts whose executor was lost after writing
            if f not in kept:
                store.delete_file(f"{root}/{f}")
        store.create_dir(root, recursive=True)
        new = f"{root}/_new-{self.job}-{MANIFEST}"
        pq.write_table(table, new, filesystem=store)
        store.move(new, f"{root}/{MANIFEST}")

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        for f in self._own_files():
            store.delete_file(f"{root}/{f}")


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        ranges = json.loads(self.options["shards"]) if "shards" in self.options else {"": None}
        for folder in ranges:
            for f in shard_files(self.options["path"], folder)[:1]:
                store, root = _open(self.options["path"])
                stored = from_arrow_schema(pq.read_schema(f"{root}/{f}", filesystem=store))
                return stored.add(self.options["folder"], T.StringType()) if "folder" in self.options else stored
        raise ValueError("a folder without shards needs a schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ShardReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return ShardStreamReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if not overwrite:
            raise ValueError("shards are written as a whole: use mode('overwrite')")
        return ShardWriter(self.options)


def register_source(spark: SparkSession) -> None:
    spark.dataSource.register(ShardSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---------------------------------------------------------------- IO9 with commit
def write_committed(df: DataFrame, path: str, order: Sequence, shard_size: int = 10_000,
                    form: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """IO9: ``df`` as fixed-size shards and their manifest, which appear together; returns the manifest.
    ``form`` makes the records from the numbered rows, as in ``shards.write_shards``.

    Files of an earlier write stay on disk until they are cleaned up, but are no longer read."""
    from parley.operators.shards import assign_shards, dealt
    spark = df.sparkSession
    register_source(spark)
    s = dealt(assign_shards(df, order, shard_size))
    (form(s) if form else s).write.format(FORMAT).mode("overwrite").save(path)
    return spark.read.parquet(f"{path}/{MANIFEST}")


# ---------------------------------------------------------------- IO5: early stop
def write_source_folders(df: DataFrame, path: str, key: str, order: Sequence[str], shard_rows: int) -> None:
    """One folder ``key=value`` for each source, of shards that ascend by ``order``; a large source is written by many tasks."""
    (df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).write.mode("overwrite").option("maxRecordsPerFile", shard_rows)
     .partitionBy(key).parquet(path))


def read_until_quota(spark: SparkSession, path: str, wanted: dict[str, int], accept: Callable[[DataFrame], DataFrame], order: Sequence[str | Column],
                     scratch: str, schema: T.StructType | str | None = None, first_wave: int = 1) -> tuple[DataFrame, DataFrame]:
    """W1 on sources that are folders of ordered shards: the first ``wanted[folder]`` accepted rows of each, without reading the rest.

    ``accept`` maps the rows read, with their ``folder``, to accepted rows (keeping ``folder``). Shards must ascend by ``order``: rows of a later shard come
    after those of an earlier one. Each wave reads the next shards of the sources that are still short, as many as the yield so far
    says (at most four times those read), and is written below ``scratch``; the driver holds one count for each source. Waves are few, as
    the shards read grow by a factor.

    Returns (rows, status); status has (folder, shards, shards_read, accepted) of each source. A missing folder has no shards."""
    from parley.operators.common import top_n_per_group
    register_source(spark)
    total = {f: len(shard_files(path, f)) for f in wanted}
    read, got = dict.fromkeys(wanted, 0), dict.fromkeys(wanted, 0)
    reader = spark.read.format(FORMAT).option("folder", "folder")
    if schema is not None:
        given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([*given.fields, T.StructField("folder", T.StringType())]))
    waves: list[str] = []
    while True:
        ranges = {}
        for f, want in wanted.items():
            if got[f] < want and read[f] < total[f]:
                need = 4 * read[f] if got[f] == 0 else math.ceil(1.2 * (want - got[f]) * read[f] / got[f])
                ranges[f] = [read[f], min(total[f], read[f] + (max(1, min(need, 4 * read[f])) if read[f] else first_wave))]
        if not ranges:
            break
        rows = reader.option("shards", json.dumps(ranges)).load(path)
        read.update({f: end for f, (_, end) in ranges.items()})
        waves.append(f"{scratch}/wave={len(waves)}")
        accept(rows).write.mode("overwrite").parquet(waves[-1])
        for r in spark.read.parquet(waves[-1]).groupBy("folder").count().collect():  # one row for each source
            got[r["folder"]] += r["count"]
    status = spark.createDataFrame([(f, total[f], read[f], got[f]) for f in wanted], "folder string, shards long, shards_read long, accepted long")
    if not waves:
        return accept(reader.option("shards", "{}").load(path)), status
    kept = top_n_per_group(spark.read.parquet(*waves), ["folder"], list(order), max(max(wanted.values()), 1), rank_col="_rn")
    limits = spark.createDataFrame(list(wanted.items()), "folder string, _want long")
    return kept.join(limits, "folder").filter("_rn <= _want").drop("_rn", "_want"), status
