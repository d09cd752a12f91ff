"""Parallel-corpus building: clean, filter, adapt, fan out, quota, dedup, split."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import let, norm_ws
from parley.operators.common import top_n_per_group

PAIR_COLS = ("src", "tgt", "direction")


# ---------------------------------------------------------------- PF1 / PF2 / PF3
def clean_pair(df: DataFrame, cols: Sequence[str] = ("src", "tgt")) -> DataFrame:
    """PF1: collapse Unicode whitespace runs and strip, null treated as empty."""
    return df.select(*[norm_ws(F.coalesce(F.col(c), F.lit(""))).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def keep_predicate(a, b, min_len: int = 1, max_len: int = 200, max_ratio: float = 4.0) -> Column:
    """PF3: both non-empty, lengths in [min_len, max_len], long/short <= max_ratio.

    The two lengths are bound once: a filter on cleaned columns is pushed below the cleaning and would clean again for each mention."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b

    def passes(n):
        la, lb = n["a"], n["b"]
        ratio = F.greatest(la, lb) / F.greatest(F.lit(1), F.least(la, lb))
        return (F.coalesce((la > 0) & (lb > 0) & la.between(min_len, max_len) & lb.between(min_len, max_len)
                           & (ratio <= F.lit(float(max_ratio))), F.lit(False)))
    return let(F.struct(F.length(a).alias("a"), F.length(b).alias("b")), passes)


def filter_pairs(df: DataFrame, src: str = "src", tgt: str = "tgt", min_len: int = 1,
                 max_len: int = 200, max_ratio: float = 4.0) -> DataFrame:
    """PF2: clean both sides, then keep rows passing the length and ratio test.

    A row's cleaned pair is an array that loses the pair if it fails, so both sides are cleaned once: a filter would be pushed below the
    cleaning and clean them again."""
    pair = F.array(F.struct(*[norm_ws(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in (src, tgt)]))
    kept = F.filter(pair, lambda p: keep_predicate(p[src], p[tgt], min_len, max_len, max_ratio))
    return df.select(*[c for c in df.columns if c not in (src, tgt)], F.inline(kept)).select(*df.columns)


# ---------------------------------------------------------------- PF4 adapters
def adapt_source(df: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """PF4: (en, zh) from a source record by schema tag; unknown tag gives empty strings."""
    if schema == "translation":
        en, zh = F.col("translation.en"), F.col("translation.zh")
    elif schema == "st_pair":
        en, zh = F.col("english"), F.col("non_english")
    else:
        en, zh = F.lit(""), F.lit("")
    return df.select(*keep, F.coalesce(en, F.lit("")).alias("en"), F.coalesce(zh, F.lit("")).alias("zh"))


# ---------------------------------------------------------------- PF5 / PF6
def fan_out(pairs: DataFrame, zh: str = "zh", en: str = "en", keep: Sequence[str] = ()) -> DataFrame:
    """PF5: each (zh, en) pair becomes a zh2en row and an en2zh row, in one generate."""
    rows = F.array(
        F.struct(F.col(zh).alias("src"), F.col(en).alias("tgt"), F.lit("zh2en").alias("direction")),
        F.struct(F.col(en).alias("src"), F.col(zh).alias("tgt"), F.lit("en2zh").alias("direction")))
    return pairs.select(*keep, F.inline(rows))


def pair_key(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """PF6: canonical (zh, en) of a directed row; any direction but zh2en counts as en2zh, null text as empty."""
    is_zh2en = F.col("direction") == "zh2en"
    return df.select(*keep,
                     F.coalesce(F.when(is_zh2en, F.col("src")).otherwise(F.col("tgt")), F.lit("")).alias("zh"),
                     F.coalesce(F.when(is_zh2en, F.col("tgt")).otherwise(F.col("src")), F.lit("")).alias("en"))


# ---------------------------------------------------------------- SO3 / SK4 / J3 / SO4
def unique_pairs(directed: DataFrame) -> DataFrame:
    """SO3: collapse directed rows (both directions) to unique (zh, en) pairs."""
    return pair_key(directed).dropDuplicates(["zh", "en"])


def split_order(seed: int) -> list[Column]:
    """Seeded hash order used to pick test pairs: md5(seed|zh|en), then zh, en."""
    h = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col("zh"), F.lit("|"), F.col("en")))
    return [h, F.col("zh"), F.col("en")]


def split_pairs(directed: DataFrame, test_size: int = 2000, seed: int = 42):
    """SK4 + J3 + SO4: leak-free split of unique pairs.

    ``n_test = min(test_size, n_unique // 5)`` pairs chosen by a seeded hash
    order (top-k, no full sort); train = anti join with the test keys.
    Returns (train_pairs, test_pairs, n_test).
    """
    # materialized once in the shared checkpoint folder: count, top-k and anti join all read it
    uniq = unique_pairs(directed).checkpoint(eager=True)
    n_unique = uniq.count()
    n_test = min(int(test_size), n_unique // 5)
    test = uniq.orderBy(*split_order(seed)).limit(n_test).select("zh", "en")
    train = uniq.join(test, ["zh", "en"], "left_anti")
    return train, test, n_test


def label_split(directed: DataFrame, test_size: int = 2000, seed: int = 42) -> DataFrame:
    """Unique pairs with a ``split`` column ('train' / 'test')."""
    train, test, _ = split_pairs(directed, test_size, seed)
    assert_disjoint(train, test)
    return (train.select("zh", "en", F.lit("train").alias("split"))
            .unionByName(test.select("zh", "en", F.lit("test").alias("split"))))


def members(directed: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Directed rows whose canonical pair is (left_semi) / is not (left_anti) in ``keys``."""
    keyed = pair_key(directed, keep=directed.columns)
    return keyed.join(keys.select("zh", "en"), ["zh", "en"], how).select(*directed.columns)


def assert_disjoint(train: DataFrame, test: DataFrame) -> None:
    """SO4: raise when a pair is in both train and test."""
    if not train.join(test.select("zh", "en"), ["zh", "en"], "left_semi").isEmpty():
        raise AssertionError("train/test pair leak")


def split_report(labeled: DataFrame) -> DataFrame:
    """AG19: unique pairs, train and test counts in one row."""
    return labeled.agg(F.count(F.lit(1)).alias("unique_pairs"),
                       F.count_if(F.col("split") == "train").alias("train"),
                       F.count_if(F.col("split") == "test").alias("test"))


# ---------------------------------------------------------------- SK5 / SK6
def head_rows(df: DataFrame, order_by: Sequence, n: int | None) -> DataFrame:
    """SK5: the first ``n`` rows by an explicit order (TakeOrdered: at most n rows per task);
    ``None`` or 0 keeps all rows."""
    return df.orderBy(*order_by).limit(n) if n else df


def sorted_by(df: DataFrame, col: str = "direction") -> DataFrame:
    """SK6: listing sorted by ``col`` at the sink."""
    return df.orderBy(col)


# ---------------------------------------------------------------- W1 / W2 / AG18
def quota_targets(total: int, spoken_ratio: float = 0.7) -> dict[str, int]:
    """spoken = int(total * ratio), general = total - spoken."""
    spoken = int(total * spoken_ratio)
    return {"spoken": spoken, "general": total - spoken}


def apply_quota(accepted: DataFrame, sources: DataFrame, targets: dict[str, int],
                order_by: Sequence, salt_buckets: int | None = None) -> DataFrame:
    """First ``want`` accepted rows of each source, want chosen by the source kind.

    Filters are applied before this call (quotas count accepted rows only). A null source is a source.
    One pass: the largest want is the literal limit of the window (so
    WindowGroupLimit stays in the plan), and each kind keeps its own share.
    """
    wanted = {k: w for k, w in targets.items() if w > 0}
    named = sources.select(F.col("source").alias("_source"), "kind")
    tagged = accepted.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").filter(F.col("kind").isin(list(wanted)))
    if not wanted:
        return tagged
    top = top_n_per_group(tagged, ["source"], order_by, max(wanted.values()), rank_col="_rn", salt_buckets=salt_buckets)
    want = F.create_map(*[F.lit(x) for kw in wanted.items() for x in kw])
    return top.filter(F.col("_rn") <= want[F.col("kind")]).drop("_rn")


def source_counts(kept: DataFrame) -> DataFrame:
    """AG18: accepted pairs per (source, kind), rows = 2 * pairs, plus a total row. A null source keeps its own row."""
    g = kept.rollup("kind", "source").agg(F.count(F.lit(1)).alias("pairs"), F.grouping_id().alias("_g")).filter(F.col("_g").isin(0, 3))
    total = F.col("_g") == 3
    return g.select(F.when(total, F.lit("__total__")).otherwise(F.col("source")).alias("source"),
                    F.when(total, F.lit("__total__")).otherwise(F.col("kind")).alias("kind"),
                    "pairs", (F.col("pairs") * 2).alias("rows"))


# ---------------------------------------------------------------- PF7 / W3
def calib_segments(docs: DataFrame, text: str = "text", lang: str = "lang",
                   id_col: str = "doc_id", min_chars: int = 16) -> DataFrame:
    """PF7: split text at newlines, normalize whitespace, keep segments >= min_chars."""
    seg = docs.select(id_col, lang, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "raw"))
    seg = seg.select(id_col, lang, F.col("pos").cast("int").alias("pos"), norm_ws("raw").alias("segment"))
    return seg.filter(F.length("segment") >= min_chars)


def per_lang_limit(segments: DataFrame, per_lang: int, order_by: Sequence = ("doc_id", "pos"),
                   salt_buckets: int | None = None) -> DataFrame:
    """First ``per_lang`` segments of each language."""
    return top_n_per_group(segments, ["lang"], list(order_by), per_lang, salt_buckets=salt_buckets)
