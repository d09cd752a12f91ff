"""Operator 10, WARC archives and their merged capture index.

* Writing. Records of equal payload (SHA-1 and length) are judged by one grouping: the largest page id is the ``response``, the others are
  ``revisit`` records that name it and carry no payload. Payloads under ``min_bytes`` are always responses. Each task writes archive files
  through Spark's writer into the shared folder: complete WARC/1.1 records, gzip-compressed by file. A file ends with the record that fills it to
  ``file_bytes`` (or ``rows_per_file``), so only a single longer record makes a longer file.
* Reading. A file's compressed bytes are inflated piece by piece and parsed by Content-Length, so one record at a time is held, however
  long it is; digests are computed anew from what was read.
* Index. Every archive file yields a capture run, sorted by (URL key, timestamp, page id). Runs are range-partitioned by that key, in ranges
  of about ``range_rows`` captures, and each range merges its parts of the runs, in the order they come, with a loser tree. This gives the globally
  ordered capture history: ``seq`` within ``part``, and ``history_pos`` over all.

The timestamp is a base time plus the page id in seconds, since pages carry none. Null html is an empty payload, a null url the key ``-``.
Null page ids sort first, and are written as an empty id. Repeated rows each give a record and a row; rows equal in id and payload are each a
response no less than the other: a record is a revisit only of a larger id.
"""
from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from parley.llm import common as C
from parley.session import scratch_path

FILE_BYTES = 64 << 20
ROWS_PER_FILE = 50_000
RANGE_ROWS = 200_000
STEP_BYTES = 1 << 20
BASE_TIME = "2024-01-01 00:00:00"
INDEX = "urlkey string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, archive string, offset long"


class LoserTree:
    """Merges sorted lists: ``k`` leaves, each match's loser stays at its node, the winner goes on; ties go to the lower list."""

    def __init__(self, lists: list[list], key):
        self.lists, self.key, self.k = lists, key, max(1, len(lists))
        self.at = [0] * self.k
        self.loser = [-1] * self.k
        self.head = [self._key(i) for i in range(self.k)]
        for i in range(self.k - 1, -1, -1):
            self._replay(i, building=True)

    def _key(self, i: int):
        if i < len(self.lists) and self.at[i] < len(self.lists[i]):
            return (0, self.key(self.lists[i][self.at[i]]), i)
        return (1,)

    def _replay(self, i: int, building: bool = False) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.loser[node]
            if building and other < 0:
                self.loser[node] = i
                return
            if self.head[other] < self.head[i]:
                self.loser[node], i = i, other
            node //= 2
        self.loser[0] = i

    def __iter__(self) -> Iterator:
        while True:
            i = self.loser[0]
            if self.head[i][0]:
                return
            yield self.lists[i][self.at[i]]
            self.at[i] += 1
            self.head[i] = self._key(i)
            self._replay(i)


def surt(url: str | None) -> str:
    """URL key: host labels reversed, then port, path and query; scheme, fragment, user, ``www.`` and letter case of the host do not count."""
    if not url:
        return "-"
    rest = url.split("#", 1)[0]
    rest = rest.split("://", 1)[1] if "://" in rest else rest
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:]
    name, _, port = host.partition(":")
    name = name.removeprefix("www.")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (path or "/")


def judged(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to): refers_to is null for responses."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").cast("long").alias("bytes"))
    # Only digests held twice are joined: one row for each such digest
    shared = rows.groupBy("sha", "bytes").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n").checkpoint()
    joined = rows.join(C.small_side(shared, 100_000), ["sha", "bytes"], "left")
    other = (F.col("bytes") >= min_bytes) & F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select("page_id", "url", "html", "sha", "bytes", F.when(other, F.col("newest")).alias("refers_to"))


def _header(*fields: tuple[str, Column]) -> Column:
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")), F.lit("")) for k, v in fields], F.lit("\r\n"))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
                   rows_per_file: int = ROWS_PER_FILE, file_bytes: int = FILE_BYTES) -> None:
    """One WARC record for each row; files end on whole records, and are cut by their bytes before compression."""
    d = judged(pages, id_col, url_col, html_col, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    date = F.date_format(F.lit(BASE_TIME).cast("timestamp") + F.make_dt_interval(secs=F.coalesce("page_id", F.lit(0)).cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = _header(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", _urn(F.col("page_id"))),
        ("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", "")), ("WARC-Date", date), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.upper("sha"))),
        ("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))), ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Payload-Length", F.col("bytes").cast("string")), ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))))
    record = F.concat(head, F.when(revisit, "").otherwise(F.col("html")))
    cut = d.select(record.alias("value")).mapInArrow(_with_cut(file_bytes), "value string, cut long")
    (cut.write.partitionBy("cut").option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", rows_per_file).text(folder))


def _with_cut(file_bytes: int):
    """Numbers a task's files: a record belongs to the file in whose ``file_bytes`` it starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for b in batches:
            sizes = pc.binary_length(b.column(0)).to_numpy(zero_copy_only=False).astype(np.int64) + 4
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(starts // file_bytes)], names=["value", "cut"])
    return run


def inflated(data: bytes, step: int = STEP_BYTES) -> Iterator[bytes]:
    """The content of gzip members in pieces of at most ``step`` bytes."""
    while data:
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = member.decompress(data, step)
            data = member.unconsumed_tail
            if piece:
                yield piece
            elif not data and not member.eof:
                raise ValueError("the archive ends inside a gzip member")
        data = member.unused_data


def parse_archive(pieces: Iterable[bytes]) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, content block) of each record of an archive given in pieces; offsets are in the uncompressed file."""
    pieces, held, at = iter(pieces), bytearray(), 0

    def more() -> None:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError(f"the archive ends inside the record at {at}")
        held.extend(piece)

    for piece in pieces:
        held.extend(piece)
        while held:
            seen = 0
            while (end := held.find(b"\r\n\r\n", seen)) < 0:
                seen = max(0, len(held) - 3)
                more()
            lines = held[:end].decode("utf-8").split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            stop = end + 4 + size + 4
            while len(held) < stop:
                more()
            yield at, fields, bytes(held[end + 4:end + 4 + size])
            del held[:stop]
            at += stop


def _id(urn: str | None) -> int | None:
    inner = urn[len("<urn:page:"):-1] if urn else ""
    return int(inner) if inner else None


def _run_key(r: dict) -> tuple:
    return r["urlkey"], r["timestamp"], r["page_id"] if r["page_id"] is not None else C.NULL_ID, r["archive"], r["offset"]


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive file as a run of captures, sorted by key."""
    schema = pa.schema([("urlkey", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), ("archive", pa.string()), ("offset", pa.int64())])
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            name = "/".join(path.rsplit("/", 2)[1:])  # files of one task differ by their folder
            run = []
            for offset, h, block in parse_archive(inflated(content.as_py())):
                revisit = h["WARC-Type"] == "revisit"
                digest = base64.b32encode(bytes.fromhex(h["WARC-Payload-Digest"][5:])) if revisit else base64.b32encode(hashlib.sha1(block).digest())
                uri = h.get("WARC-Target-URI")
                run.append({"urlkey": surt(uri), "timestamp": h["WARC-Date"], "page_id": _id(h["WARC-Record-ID"]),
                            "payload_bytes": int(h["WARC-Payload-Length"]) if revisit else len(block), "payload_digest": digest.decode(), "record_type": h["WARC-Type"],
                            "refers_to": _id(h.get("WARC-Refers-To")), "uri": uri, "archive": name, "offset": offset})
            run.sort(key=_run_key)
            yield pa.RecordBatch.from_pylist(run, schema)


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of keys: its parts of all runs merged by the loser tree.

    The shuffle keeps the order of what one task sent, so a run's part comes in order and is not sorted again; where a row is not
    after the one before it (as where a part came in several blocks), another run starts."""
    runs: list[list[dict]] = []
    schema, last = None, None
    for b in batches:
        schema = b.schema
        for r in b.to_pylist():
            key = _run_key(r)
            if last is None or key < last:
                runs.append([])
            runs[-1].append(r)
            last = key
    out, seq = [], 0
    if schema is None:
        return
    schema = schema.append(pa.field("seq", pa.int64()))
    for r in LoserTree(runs, _run_key):
        out.append(r | {"seq": seq})
        seq += 1
        if len(out) == 5000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return files.mapInArrow(_read_runs, INDEX)


def merged_index(spark: SparkSession, folder: str, partitions: int | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures of the archives in ``folder`` in global order of (part, seq), which is that of (urlkey, timestamp, page_id); ``history_pos``
    counts them from 0 over all parts."""
    runs = read_runs(spark, folder).checkpoint()
    ranges = partitions or max(C.partitions(spark), -(-runs.count() // range_rows))
    ranged = runs.repartitionByRange(ranges, "urlkey", "timestamp", "page_id").withColumn("part", F.spark_partition_id())
    merged = ranged.mapInArrow(_merge_runs, INDEX + ", part int, seq long").checkpoint()
    # One row for each range
    sizes = merged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return merged.join(F.broadcast(before), "part").select(*merged.columns, (F.col("before") + F.col("seq")).alias("history_pos"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes the archives of ``pages`` to a new folder beside the checkpoints, and reads their merged index back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(pages, folder, id_col, url_col, html_col, min_bytes)
    return merged_index(spark, folder)
