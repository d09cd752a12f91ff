"""Operator 3, benchmark decontamination: a positional inverted index over the training tokens, probed by rarest test terms.

DataFrame expressions only.

1. Test windows: runs of ``size`` words of each benchmark item; a shorter item that has a word is one window. Equal windows are
   one row with their item ids.
2. Term counts of the test vocabulary over all documents; each window's terms are ranked from the rarest. A window with a
   term that no document holds cannot occur and is dropped.
3. Postings (term, document, position) of the rarest and the next rarest term of each window are stored as a table in the shared folder, in
   one scan for each ``TERMS_PER_SCAN`` terms (the benchmark is the stated query set, taken in blocks). Those of rarest terms carry the
   words around them.
4. Lists are intersected in a join: a posting of the rarest term, moved by the difference of the two offsets, must stand in the list of the next
   rarest term (proximity: within ``slop`` places). Of what is left, the whole window is compared with the stored words (phrase).

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. Null or empty text has no words
and no hits; null items and items without words have no windows. Repeated rows each return a row. Empty benchmark: nothing is hit.
Null item ids count as the text ``null``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm import common as C
from parley.llm.common import let
from parley.operators.common import broadcast_if_small
from parley.session import scratch_path

SIZE = 10
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMS_PER_SCAN = 20_000
BROADCAST_ROWS = 200_000


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAP, -1), "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, CASED_GAP, -1), "")).cast("long")


def test_windows(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, items): distinct word windows and the sorted ids, as strings, of the items that hold them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    w = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), word_array(text).alias("words")).filter("size(words) > 0")
    w = w.select("item", F.explode(let(F.col("words"), lambda a: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(a) - size + 1, F.lit(1))), lambda i: F.slice(a, i, size)))).alias("window"))
    return w.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def ranked_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Adds (term, offset, term2, offset2): the rarest and next rarest of each window's terms over ``docs``."""
    terms = windows.select(F.explode("window").alias("term")).distinct().checkpoint()
    held = (docs.select(F.explode(word_array(F.col("text"))).alias("term"))
            .join(C.small_side(terms, BROADCAST_ROWS), "term", "left_semi").groupBy("term").count())
    placed = windows.select("window", "items", F.posexplode("window").alias("offset", "term")).join(held, "term", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "offset", "term")))  # at most a window's words
    ranked = placed.groupBy("window", "items").agg(order.alias("o"))
    ranked = ranked.select("window", "items", F.col("o")[0].alias("a"), F.coalesce(F.get("o", F.lit(1)), F.col("o")[0]).alias("b"))
    return ranked.filter("a.n > 0").select("window", "items", F.col("a.term").alias("term"), F.col("a.offset").alias("offset"),
                                           F.col("b.term").alias("term2"), F.col("b.offset").alias("offset2")).checkpoint()


def postings(docs: DataFrame, terms: list[str], rarest: list[str], reach: int) -> DataFrame:
    """(key_id, key_text, term, pos, first, around): positions of ``terms``, those of ``rarest`` with the words up to ``reach`` places to either side."""
    def store(a: Column) -> Column:
        at = F.array_compact(F.transform(a, lambda w, i: F.when(w.isin(terms), i)))
        return F.transform(at, lambda p: F.struct(F.element_at(a, p + 1).alias("term"), p.alias("pos"), F.greatest(p - reach, F.lit(0)).alias("first"),
                                                  F.when(F.element_at(a, p + 1).isin(rarest), F.slice(a, F.greatest(p - reach, F.lit(0)) + 1, 2 * reach + 1)).alias("around")))
    return docs.select(*C.KEYS, F.explode(let(word_array(F.col("text")), store)).alias("p")).select(*C.KEYS, "p.*")


def stored_index(docs: DataFrame, windows: DataFrame, reach: int) -> DataFrame:
    """The postings of every ranked window's two terms, written to a new folder beside the checkpoints and read back."""
    spark = docs.sparkSession
    both = F.explode(F.array(F.struct(F.col("term").alias("t"), F.lit(True).alias("rarest")), F.struct(F.col("term2").alias("t"), F.lit(False).alias("rarest"))))
    chosen = windows.select(both.alias("c")).groupBy("c.t").agg(F.max("c.rarest").alias("rarest")).orderBy("t").collect()  # at most the benchmark's words
    blocks = [chosen[i:i + TERMS_PER_SCAN] for i in range(0, len(chosen), TERMS_PER_SCAN)] or [[]]
    folder = scratch_path(spark, "postings")
    for block in blocks:
        postings(docs, [r["t"] for r in block], [r["t"] for r in block if r["rarest"]], reach).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def matches(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slop: int | None = None, item_col: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """(key_id, key_text, start, length, items) of exact phrase matches in keyed ``docs``; with ``slop`` also proximity matches,
    where the next rarest term stands within ``slop`` words of its place, told apart by the column ``phrase``."""
    windows = ranked_windows(docs, test_windows(benchmark, size, item_col, item_text))
    index = stored_index(docs, windows, size - 1 + (slop or 0))
    hit = index.filter("around is not null").join(broadcast_if_small(windows, BROADCAST_ROWS), "term").withColumn("start", F.col("pos") - F.col("offset"))
    place = F.col("start") - F.col("first")
    phrase = (F.col("start") >= 0) & (F.slice("around", F.greatest(place, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    columns = [*C.KEYS, "start", F.size("window").alias("length"), "items"]
    other = index.select(*C.KEYS, F.col("term").alias("term2"), F.col("pos").alias("pos2")).distinct()
    due = F.col("start") + F.col("offset2")
    if slop is None:
        at = hit.filter("start >= 0").withColumn("pos2", due)
        return at.join(other, [*C.KEYS, "term2", "pos2"], "left_semi").filter(phrase).select(*columns)
    at = hit.withColumn("pos2", F.explode(F.sequence(due - slop, due + slop)))
    return at.join(other, [*C.KEYS, "term2", "pos2"], "left_semi").select(*columns, phrase.alias("phrase")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(key_id, key_text, n_hit, item_list) of the keyed documents with a phrase match."""
    found = matches(docs, benchmark, size).groupBy(*C.KEYS).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_list"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda s, x: F.struct(
        F.greatest(s["end"], x["start"] + x["length"]).alias("end"),
        (s["n"] + F.greatest(x["start"] + x["length"] - F.greatest(s["end"], x["start"]), F.lit(0))).alias("n")))["n"]
    return found.select(*C.KEYS, covered.alias("n_hit"), "item_list")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_list, contaminated of each row of ``docs``."""
    d = C.keyed(docs, id_col, text_col)
    found = hits(d, benchmark, size)
    counted = d.select("doc_id", *C.KEYS, word_count(F.col("text")).alias("n_words")).join(found, C.KEYS, "left")
    return counted.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                          F.coalesce(F.size("item_list"), F.lit(0)).cast("long").alias("n_items"),
                          F.coalesce("item_list", F.array().cast("array<string>")).alias("item_list"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their columns as they were."""
    found = hits(C.keyed(docs, id_col, text_col), benchmark, size).select(F.col("key_id").alias("__id"), F.col("key_text").alias("__text"))
    row = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(C.NULL_ID)).alias("__id"),
                      F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__text"))
    return row.join(found, ["__id", "__text"], "left_anti").select("row.*")
