"""Operator 1, secret scans: three base patterns, and character Markov models compared by log-likelihood ratio.

Everything on the main path is a DataFrame expression.

* Base kinds ``assign``, ``access`` and ``hex`` are leftmost non-overlapping pattern matches; a span is the whole match in code
  points, end exclusive. Positions come from the pieces between matches (``split`` and ``regexp_extract_all`` by one pattern).
* Models. Labelled samples are (text, random) rows; each different string counts once, so copies of rows change nothing. Two first-order
  character models over ASCII are counted in Spark, random strings and ordinary tokens. ``fit`` collects at most 128 x 128 counts of each and
  mixes them with priors in proportion: half of the random model is uniform; the ordinary model gives ``PRIOR_ROWS`` of its pairs, and a twentieth
  at least, to a prior (a quarter the same character again, the rest uniform). So no ratio grows without end as rows are added.
* Kind ``markov``: each run of 20 or more token characters whose summed log-likelihood ratio is at least ``THRESHOLD`` nats is a secret.
  These spans are added; base spans stay, and the two may overlap. The ratio alone decides; shorter runs are not scored.

``corpus_samples`` labels every document's own strings: values of base spans as random, and as ordinary all runs of two or more token
characters that touch no base span. Runs long enough to be scored may be secrets themselves: a model of the others is fitted first, and those
that it holds for random are in neither class. No row is left out.

Null text counts as empty: no spans. Repeated rows each return a row. A first character that neither class has seen decides nothing, so
without samples no ``markov`` span is found. Extra columns are ignored by ``scan`` and kept by ``redact``.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import let

ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
CANDIDATE_CHARS = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
CUT = "\ue000"  # stands for base spans while tokens are read
TOKEN = rf"(?<![{CUT}A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{2,}}+(?!{CUT})"
KINDS = ["assign", "access", "hex", "markov"]
RANDOM_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
THRESHOLD = 6.9  # odds of about 1000 : 1
PRIOR_SHARE = 0.05
PRIOR_ROWS = 5
SAME = 0.25
SIZE = 128
BLOCK = 256
CHUNK_BITS = 9
NO_SPANS = "array<struct<start:int,kind_no:int,end:int,match:string>>"


def running(values: Column, combine) -> Column:
    """[0, v0, combine(v0, v1), ...]: the exclusive running result over an int array, built in blocks so that long arrays stay cheap."""
    blocks = let(values, lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")),
                                               lambda b: F.slice(a, b * BLOCK + 1, BLOCK)))

    def run(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda s, v: F.struct(combine(s["at"], v).alias("at"), F.array_append(s["out"], s["at"]).alias("out")))["out"]

    zero = F.lit(0)
    return let(blocks, lambda bs: F.flatten(F.zip_with(
        bs, run(F.transform(bs, lambda b: F.aggregate(b, zero, lambda x, y: combine(x, y))), zero), run)))


def running_starts(steps: Column) -> Column:
    """[0, s0, s0+s1, ...]: the exclusive running sums of an int array."""
    return running(steps, lambda a, b: a + b)


def regex_spans(text: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind_no, end, match) of the leftmost non-overlapping matches; matches must not be empty."""
    def build(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        return let(found, lambda m: let(
            F.slice(F.transform(F.split(t, pattern, -1), lambda p: F.length(p)), 1, F.size(m)),
            lambda gaps: let(running_starts(F.zip_with(gaps, m, lambda g, x: g + F.length(x))),
                             lambda at: F.transform(F.arrays_zip(at.alias("at"), gaps.alias("gap"), m.alias("match")), lambda z: F.struct(
                                 (z["at"] + z["gap"]).alias("start"), F.lit(kind).alias("kind_no"),
                                 (z["at"] + z["gap"] + F.length(z["match"])).alias("end"), z["match"].alias("match"))))))
    return F.when(text.rlike(pattern), let(text, build)).otherwise(F.array().cast(NO_SPANS))


def assign_value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 1)


def base_spans(text: Column) -> Column:
    assign = F.filter(regex_spans(text, ASSIGN, 0), lambda s: F.length(assign_value(s["match"])) >= 8)
    return F.concat(assign, regex_spans(text, ACCESS, 1), regex_spans(text, HEX, 2))


def _piece(chunks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text given as chunks of 2**CHUNK_BITS code points: only the chunks it touches are read."""
    first, last, low = F.shiftright(start, CHUNK_BITS), F.shiftright(end, CHUNK_BITS), (1 << CHUNK_BITS) - 1
    head = F.substring(F.get(chunks, first), start.bitwiseAND(low) + 1, F.lit(1 << CHUNK_BITS))
    tail = F.coalesce(F.substring(F.get(chunks, last), F.lit(1), end.bitwiseAND(low)), F.lit(""))
    return F.when(end <= start, F.lit("")).when(first == last, F.substring(F.get(chunks, first), start.bitwiseAND(low) + 1, end - start)).otherwise(
        F.concat(head, F.array_join(F.slice(chunks, first + 2, last - first - 1), ""), tail))


def replace_spans(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each of ``spans`` (by start) replaced by ``mark``, overlapping ones by one; linear in the text and in the spans."""
    def build(chunks: Column) -> Column:
        before = running(F.transform(spans, lambda s: s["end"]), F.greatest)  # the end of all spans up to here
        kept = F.filter(F.zip_with(spans, before, lambda s, e: F.struct(e.alias("start"), s["start"].alias("end"))), lambda p: p["end"] >= p["start"])
        rest = _piece(chunks, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.array_join(F.concat(F.transform(kept, lambda p: _piece(chunks, p["start"], p["end"])), F.array(rest)), mark)
    return F.when(F.size(spans) == 0, text).otherwise(let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << CHUNK_BITS}}}"), F.lit(0)), build))


def corpus_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(text, random), each once: values of base spans as random strings, the other tokens of all texts as ordinary ones."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def strings(spans: Column) -> Column:
        secret = F.transform(spans, lambda s: F.concat(F.lit(CUT), F.when(s["kind_no"] == 0, assign_value(s["match"])).otherwise(s["match"])))
        rest = F.when(F.size(spans) == 0, text).otherwise(let(F.translate(text, CUT, " "), lambda t: replace_spans(t, spans, CUT)))
        return F.concat(secret, F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0)))
    found = docs.select(F.explode(let(F.array_sort(base_spans(text)), strings)).alias("s")).distinct()
    samples = found.select(F.translate("s", CUT, "").alias("text"), F.col("s").startswith(CUT).alias("random")).checkpoint()
    sure = F.col("random") | (F.length("text") < CANDIDATE_CHARS)
    first = fit(samples.filter(sure))
    return samples.filter(F.when(sure, True).otherwise(log_ratio(F.col("text"), first) < THRESHOLD))


def fit(samples: DataFrame, alpha: float = 0.5) -> list[float]:
    """Log-likelihood ratios random : ordinary of each character pair, at index 128 * first + second; ``alpha`` is the uniform share of random."""
    codes = let(F.transform(F.split(F.col("text"), ""), lambda c: F.ascii(c)), lambda a: F.transform(
        F.sequence(F.lit(1), F.size(a) - 1), lambda i: F.struct(F.element_at(a, i).alias("x"), F.element_at(a, i + 1).alias("y"))))
    pairs = (samples.filter(F.length("text") > 1).select("random", "text").distinct().select("random", F.explode(codes).alias("p")).select("random", "p.*")
             .filter((F.col("x") < SIZE) & (F.col("y") < SIZE)).groupBy("random", "x", "y").count())
    counts = {(r["random"], r["x"], r["y"]): r["count"] for r in pairs.collect()}  # at most 2 x 128 x 128 rows
    letters = {ord(c) for c in RANDOM_ALPHABET}
    weight = [1.0 if y in letters else 1 / SIZE for y in range(SIZE)]
    uniform = [w / sum(weight) for w in weight]

    def ratios(x: int) -> list[float]:
        rand, plain = ([counts.get((label, x, y), 0) for y in range(SIZE)] for label in (True, False))
        n_rand, n_plain = sum(rand), sum(plain)
        if not n_rand and not n_plain:
            return [0.0] * SIZE
        own = alpha if n_rand else 1.0
        share = max(PRIOR_SHARE, PRIOR_ROWS / (PRIOR_ROWS + n_plain))
        return [math.log((1 - own) * rand[y] / max(n_rand, 1) + own * uniform[y])
                - math.log((1 - share) * plain[y] / max(n_plain, 1) + share * (SAME * (x == y) + (1 - SAME) * uniform[y])) for y in range(SIZE)]

    return [v for x in range(SIZE) for v in ratios(x)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """Summed log-likelihood ratio of the character pairs of an ASCII string."""
    table = F.split(F.lit(",".join(f"{v:.6f}" for v in model)), ",").cast("array<double>")
    return let(F.transform(F.split(token, ""), lambda c: F.ascii(c)), lambda a: F.aggregate(
        F.sequence(F.lit(1), F.size(a) - 1), F.lit(0.0),
        lambda s, i: s + F.element_at(table, F.element_at(a, i) * SIZE + F.element_at(a, i + 1) + 1)))


def all_spans(text: Column, model: list[float]) -> Column:
    """Base and model spans by start, then kind in the order of KINDS."""
    added = F.filter(regex_spans(text, CANDIDATE, 3), lambda s: log_ratio(s["match"], model) >= THRESHOLD)
    return F.array_sort(F.concat(base_spans(text), added))


def spans_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_no"] == kind)).cast("long")


def scan(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), let(all_spans(text, model), lambda a: F.struct(
        *[_count(a, k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(spans_text(F.filter(a, lambda s: s["kind_no"] < 3)), 256).alias("base_sha256"), spans_text(a).alias("spans"))).alias("r"))
    return d.select("doc_id", "r.*")


def redact(docs: DataFrame, model: list[float], text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``mark`` (overlapping spans by one); null text stays null."""
    def cut(t: Column) -> Column:
        return let(all_spans(t, model), lambda a: replace_spans(t, a, mark))
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), let(F.col(text_col), cut)))
