"""Row-local mapping of id arrays (J1, J2, SQ1, SQ2, SQ3, SQ5, SQ6, SQ8) through a compiled lookup.

A map (vocabulary-sized, counted in rows and bytes before it is collected) becomes two sorted arrays in a broadcast variable. Arrow
functions look up all ids of a batch at once on the list's flat values and rebuild offsets, so no token is shuffled, rows of equal or
null key stay apart, and the same columns work on a streaming DataFrame. A map beyond those bounds goes to blocks of rows instead (``_by_blocks``).

Ids that occur more than once in a map take their smallest value. Null ids are dropped where unknown ids are dropped, and count as
unknown where lengths are kept. Null arrays stay null; the DataFrame forms turn them into empty ones.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string

from parley.operators.common import MAX_BROADCAST_BYTES, fits

# Upper bound on vocabulary-map rows that may be sent to the executors (tokenizer id space).
MAX_MAP_ROWS = 1_000_000
NO_ID = np.int64(-(1 << 63))
# Ids of a block of rows when a map is beyond the bound: what one task holds at a time, beside the distinct ids' values.
BLOCK_TOKENS = 1 << 20
BLOCK = "__block"
_ARROW = {"array<int>": pa.list_(pa.int32()), "string": pa.string()}


def compile_lookup(table: DataFrame, src: str, dst: str, max_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> Broadcast | None:
    """The sorted ids and their values as a broadcast variable; None if the table is beyond the bounds."""
    m = table.select(F.col(src).cast("long").alias("k"), F.col(dst).alias("v")).filter("k is not null and v is not null")
    if not fits(m, MAX_MAP_ROWS if max_rows is None else max_rows, max_bytes):
        return None
    t = m.groupBy("k").agg(F.min("v").alias("v")).toArrow().combine_chunks().sort_by("k")
    keys = t.column("k").to_numpy()
    return table.sparkSession.sparkContext.broadcast((keys, _one(t.column("v"))))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def positions(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each id in the sorted ``keys``, -1 when absent."""
    if not len(keys):
        return np.full(len(ids), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, ids), len(keys) - 1)
    return np.where(keys[at] == ids, at, -1)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids with null as NO_ID, row of each id, whether each row is null)."""
    flat = pc.list_flatten(lists).cast(pa.int64())
    ids = flat.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False) if flat.null_count else flat.to_numpy(zero_copy_only=False)
    return ids, pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), np.asarray(lists.is_null())


def _lists(values: pa.Array, row: np.ndarray, null: np.ndarray) -> pa.ListArray:
    ends = np.cumsum(np.bincount(row, minlength=len(null))) if len(row) else np.zeros(len(null), np.int64)
    offsets = np.zeros(len(null) + 1, np.int32)
    offsets[1:] = ends
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(null))


def mapped(ids: Column, lookup: Broadcast, unk: int | None = None, inverse: bool = False) -> Column:
    """SQ1 / SQ2: array<int> of the mapped ids; unknown ids are dropped, replaced by ``unk``, or raise (``inverse``)."""
    @F.arrow_udf("array<int>")
    def run(lists: pa.Array) -> pa.Array:
        keys, values = lookup.value
        return _mapped_batch(lists, keys, values.to_numpy(zero_copy_only=False), unk, inverse)
    return run(ids)


def _mapped_batch(lists: pa.Array, keys: np.ndarray, values: np.ndarray, unk: int | None, inverse: bool) -> pa.ListArray:
    flat, row, null = _flat(lists)
    at = positions(flat, keys)
    known, present = at >= 0, flat != NO_ID
    if inverse and (present & ~known).any():
        raise ValueError(f"unknown new id {int(flat[present & ~known][0])}")
    kept = known if unk is None else known | present
    new = np.full(len(flat), 0 if unk is None else unk, np.int32)
    new[known] = values[at[known]]
    return _lists(pa.array(new[kept]), row[kept], null)


def kept_length(ids: Column, lookup: Broadcast, oov: int, ignore: int) -> Column:
    """SQ6: array<int> of the same length: ``ignore`` stays, other ids are mapped, unknown ones become ``oov``."""
    @F.arrow_udf("array<int>")
    def run(lists: pa.Array) -> pa.Array:
        keys, values = lookup.value
        flat, row, null = _flat(lists)
        at = positions(flat, keys)
        new = np.full(len(flat), oov, np.int32)
        new[at >= 0] = values.to_numpy(zero_copy_only=False)[at[at >= 0]]
        new[flat == ignore] = ignore
        return _lists(pa.array(new), row, null)
    return run(ids)


def unknown_counts(ids: Column, lookup: Broadcast, ignore: int | None = None) -> Column:
    """PF15 / AG3 / AG8: struct of tok, oov and first: the ids of a row, how many are not in the map, and whether the first one is not.
    ``ignore`` and, if it is given, null ids do not count; without it a null id is an unknown one."""
    @F.arrow_udf("tok bigint, oov bigint, first boolean")
    def run(lists: pa.Array) -> pa.Array:
        keys, _ = lookup.value
        flat, row, null = _flat(lists)
        if ignore is not None:
            counted = (flat != ignore) & (flat != NO_ID)
            flat, row = flat[counted], row[counted]
        unknown = positions(flat, keys) < 0
        tok = np.bincount(row, minlength=len(null))
        first = np.zeros(len(null), bool)
        first[tok > 0] = unknown[(np.cumsum(tok) - tok)[tok > 0]]
        oov = np.bincount(row[unknown], minlength=len(null))
        return pa.StructArray.from_arrays([pa.array(tok, pa.int64()), pa.array(oov, pa.int64()), pa.array(first)], ["tok", "oov", "first"])
    return run(ids)


def mapped_pairs(ids: Column, scores: Column, lookup: Broadcast, id_type: str = "int") -> Column:
    """SQ8: struct of keep_pos, new_ids and raw: the known ids of a top-k row with their places and scores. Both arrays have one length."""
    @F.arrow_udf(f"keep_pos array<int>, new_ids array<{id_type}>, raw array<double>")
    def run(lists: pa.Array, scores: pa.Array) -> pa.Array:
        keys, values = lookup.value
        flat, row, null = _flat(lists)
        at = positions(flat, keys)
        known = at >= 0
        first = np.searchsorted(row, row)  # rows are in order: the place of a row's first id
        place = (np.arange(len(row)) - first).astype(np.int32)
        raw = pc.list_flatten(scores).cast(pa.float64()).filter(pa.array(known))
        row = row[known]
        return pa.StructArray.from_arrays([_lists(pa.array(place[known]), row, null), _lists(values.take(pa.array(at[known])), row, null),
                                           _lists(raw, row, null)], ["keep_pos", "new_ids", "raw"])
    return run(ids, scores)


def decoded(ids: Column, pieces: Broadcast, sep: str = "") -> Column:
    """U2 / SQ3: the pieces of the ids joined by ``sep``; unknown ids give ''."""
    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        keys, values = pieces.value
        return _decoded_batch(lists, keys, values, sep)
    return run(ids)


def _decoded_batch(lists: pa.Array, keys: np.ndarray, values: pa.Array, sep: str) -> pa.Array:
    flat, row, null = _flat(lists)
    at = positions(flat, keys)
    text = values.take(pa.array(np.where(at < 0, None, at), pa.int64())).cast(pa.string()).fill_null("")
    return pc.binary_join(_lists(text, row, null), sep).cast(pa.string())


# ---------------------------------------------------------------- maps beyond a broadcast
def _with_block(ids_col: str, tokens: int):
    """Numbers blocks of a task's rows: each ends with the row that fills it to ``tokens`` ids (a row counts one more than its ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, before = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            sizes = pc.fill_null(pc.list_value_length(b.column(ids_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first + starts // tokens)], names=[*b.schema.names, BLOCK])
    return run


def _by_blocks(df: DataFrame, ids_col: str, table: DataFrame, src: str, dst: str, out_col: str, out_type: str, batch) -> DataFrame:
    """``batch(lists, keys, values)`` as a column of ``df``, for a map of any size (batch only).

    Rows are numbered by blocks of ``BLOCK_TOKENS`` ids. Only the distinct ids of each block are sent to the map, which is dealt out by id; each
    block then gets the part of the map that it needs, sorted, and its rows are filled whole. So no exploded token is shuffled, a task holds
    one block and its part of the map, and rows of equal or null key stay apart.
    """
    if df.isStreaming:
        raise ValueError("a stream can be mapped only through a map within the broadcast bound")
    schema = StructType([*df.schema.fields, StructField(BLOCK, LongType())])
    rows = df.mapInArrow(_with_block(ids_col, BLOCK_TOKENS), schema).checkpoint()
    wanted = rows.select(BLOCK, F.explode(F.col(ids_col).cast("array<long>")).alias("__k")).filter("__k is not null").distinct()
    m = table.select(F.col(src).cast("long").alias("__k"), F.col(dst).alias("__v")).filter("__k is not null and __v is not null")
    part = wanted.join(m.groupBy("__k").agg(F.min("__v").alias("__v")), "__k").select(F.col(BLOCK).alias("__to"), "__k", "__v")
    kept = [f for f in df.schema.fields if f.name != out_col]
    result = StructType([*kept, StructField(out_col, _parse_datatype_string(out_type))])

    def fill(rows: pa.Table, part: pa.Table) -> pa.Table:
        part = part.sort_by("__k").combine_chunks()
        keys, values = part.column("__k").to_numpy(), _one(part.column("__v"))
        done = pa.chunked_array([batch(c, keys, values) for c in rows.column(ids_col).chunks], _ARROW[out_type])
        return rows.select([f.name for f in kept]).append_column(out_col, done)
    return rows.groupBy(BLOCK).cogroup(part.groupBy("__to")).applyInArrow(fill, result).select(*_order(df.columns, out_col))


def _order(columns: list[str], out_col: str) -> list[str]:
    return columns if out_col in columns else [*columns, out_col]


def mapped_by_blocks(df: DataFrame, ids_col: str, table: DataFrame, src: str, dst: str, out_col: str, unk: int | None = None,
                     inverse: bool = False) -> DataFrame:
    """SQ1 / SQ2 for a map beyond the broadcast bound, with the rules of ``mapped``; null arrays give []."""
    def batch(lists, keys, values):
        done = _mapped_batch(lists, keys, values.to_numpy(zero_copy_only=False), unk, inverse)
        return done.fill_null(pa.scalar([], done.type))
    return _by_blocks(df, ids_col, table, src, dst, out_col, "array<int>", batch)


def decoded_by_blocks(df: DataFrame, ids_col: str, pieces: DataFrame, src: str, dst: str, out_col: str, sep: str = "") -> DataFrame:
    """U2 / SQ3 for a piece table beyond the broadcast bound, with the rules of ``decoded``; null arrays give ''."""
    def batch(lists, keys, values):
        return _decoded_batch(lists, keys, values, sep).fill_null("")
    return _by_blocks(df, ids_col, pieces, src, dst, out_col, "string", batch)
