"""Tokenizers as Column expressions (U1) and vocabulary-table decoding.

``codepoint`` (code point ids) decodes an Arrow batch of texts at once.
``char`` (characters), ``whitespace`` (Python ``str.split()`` words) and ``utf8``
(UTF-8 byte values) stay JVM-side. An external tokenizer file (``tokenizers`` JSON) is sent
to the executors by content and runs in an iterator pandas UDF that parses it
once per Python worker.
"""
from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.text import words

MAX_PIECES = 2_000_000
MAX_TOKENIZER_BYTES = 256 << 20
KEPT_TOKENIZERS = 2
_LOADED: dict = {}  # of this worker: content digest -> parsed tokenizer, last used last


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chars(c) -> Column:
    """Characters (code points) of a string; empty or null gives []."""
    c = _c(c)
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(c, ""))


def _decoded(texts: pa.Array) -> tuple[memoryview, np.ndarray, list[str]]:
    """(bytes of all texts, where each ends, their characters). Null is empty; the characters are one string, or where bytes are not UTF-8 one for each text, with U+FFFD."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = memoryview(texts.buffers()[2] or b"")[int(ends[0]):int(ends[-1])]
    ends = ends[1:] - ends[0]
    try:
        return data, ends, [str(data, "utf-8")]
    except UnicodeDecodeError:
        return data, ends, [str(data[i:j], "utf-8", "replace") for i, j in zip([0, *ends[:-1]], ends, strict=True)]


def codepoints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, number of each text's): the texts' bytes are decoded at once. Null is empty, bytes that are not UTF-8 are U+FFFD."""
    data, ends, each = _decoded(texts)
    points = np.frombuffer("".join(each).encode("utf-32-le"), np.int32)
    if len(each) == len(ends):
        return points, np.array([len(t) for t in each], np.int64)
    first = np.frombuffer(data, np.uint8) & 0xC0 != 0x80   # a character's first byte
    return points, np.diff(np.concatenate([[0], np.cumsum(first)])[ends], prepend=0)


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, number of each text's). Null is empty, bytes that are not UTF-8 are those of U+FFFD."""
    data, ends, each = _decoded(texts)
    if len(each) != len(ends):
        return np.frombuffer(data, np.uint8), np.diff(ends, prepend=0)
    each = [t.encode() for t in each]
    return np.frombuffer(b"".join(each), np.uint8), np.array([len(t) for t in each], np.int64)


def codepoint_ids(c) -> Column:
    """Code points of a string; empty or null gives []."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        ids, sizes = codepoints(texts)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))
    return run(_c(c))


def utf8_byte_ids(c) -> Column:
    """UTF-8 byte values 0..255 of a string (hex computed once, split in 2-digit chunks)."""
    h = F.hex(F.encode(F.coalesce(_c(c), F.lit("")), "UTF-8"))
    pairs = F.filter(F.split(F.regexp_replace(h, "(..)", "$1,"), ","), lambda x: x != "")
    return F.when(F.length(h) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int")))


@dataclass(frozen=True)
class Tokenizer:
    """``encode`` maps a string Column to array<int> token ids. ``flat``, where there is one, maps an Arrow batch of texts to all of its ids
    (not negative) and the number of each text's, so that statistics need no row for each token."""
    name: str
    encode: Callable[[Column], Column]
    flat: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]] | None = None


CODEPOINT = Tokenizer("codepoint", codepoint_ids, codepoints)
UTF8 = Tokenizer("utf8", utf8_byte_ids, utf8_bytes)


def _file_content(path: str, max_bytes: int) -> bytes:
    """The file's bytes: from the driver's own disk if it is there, else through Spark's reader (any store that Spark knows)."""
    if os.path.exists(path):
        size = os.path.getsize(path)
        read = Path(path).read_bytes
    else:
        files = SparkSession.active().read.format("binaryFile").load(path)
        size = files.agg(F.sum("length")).first()[0] or 0
        read = lambda: bytes(files.select("content").first()[0])
    if not 0 < size <= max_bytes:
        raise ValueError(f"{path}: {size} bytes; a tokenizer file has 1 to {max_bytes}")
    return read()


def _loaded(digest: str, content: bytes):
    """The tokenizer of that content, parsed once per worker; the two used last are kept."""
    tok = _LOADED.pop(digest, None)
    if tok is None:
        from tokenizers import Tokenizer as HFTokenizer
        tok = HFTokenizer.from_buffer(content)
        while len(_LOADED) >= KEPT_TOKENIZERS:
            _LOADED.pop(next(iter(_LOADED)))
    _LOADED[digest] = tok
    return tok


def file_tokenizer(path: str, add_special_tokens: bool = False, max_bytes: int = MAX_TOKENIZER_BYTES) -> Tokenizer:
    """External ``tokenizers`` JSON file, applied in Arrow batches on the executors.

    The driver reads the file when this is called (at most ``max_bytes``) and sends its content as a broadcast variable, so no
    executor needs the path. Workers keep the parsed tokenizer by content, across tasks and queries. Null text encodes as ''.
    """
    content = _file_content(path, max_bytes)
    digest = hashlib.sha256(content).hexdigest()
    shipped = SparkSession.active().sparkContext.broadcast(content)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from parley.functions import tokenize
        tok = tokenize._loaded(digest, shipped.value)
        for s in batches:
            enc = tok.encode_batch(s.fillna("").tolist(), add_special_tokens=add_special_tokens)
            yield pd.Series([e.ids for e in enc])

    return Tokenizer(f"file:{path}", lambda c: _encode(_c(c)))


def piece_table(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(token_id, piece) for the code point tokenizer, derived from observed text: the distinct ones of each batch, then of all."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.flatnonzero(np.bincount(codepoints(b.column(0))[0]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([chr(i) for i in ids], pa.string())], ["token_id", "piece"])
    return texts.select(F.col(text_col).cast("string")).mapInArrow(distinct, "token_id int, piece string").distinct()


def decode_ids(df: DataFrame, ids_col: str, pieces: DataFrame, key: str = "ex_id",
               sep: str = "") -> DataFrame:
    """(key, text): the pieces of the ids, in order.

    Row by row, on a batch or a stream, when the piece table's counted size allows it to be sent to the executors; else (batch only) through
    the distinct ids of blocks of rows. Unknown and null ids decode to ''; null arrays to ''.
    """
    from parley.operators.lookup import compile_lookup, decoded, decoded_by_blocks
    lookup = compile_lookup(pieces, "token_id", "piece", MAX_PIECES)
    if lookup is not None:
        return df.select(key, F.coalesce(decoded(F.col(ids_col), lookup, sep), F.lit("")).alias("text"))
    return decoded_by_blocks(df.select(key, ids_col), ids_col, pieces, "token_id", "piece", "text", sep).select(key, "text")
