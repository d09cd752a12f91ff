"""Token-id sequences: remap / unmap (J1, J2, SQ1-SQ3), training examples
(PF16, PF17, SQ4-SQ7, SQ11) and OOV audits (PF15, AG3, AG8, W10).

Maps within ``lookup.MAX_MAP_ROWS`` are looked up row by row (``parley.operators.lookup``): no shuffle, and the same functions run on a
streaming DataFrame. Larger ones are joined with the distinct ids of blocks of rows (``lookup.mapped_by_blocks``), so rows of equal key stay apart.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import cut
from parley.functions.tokenize import Tokenizer
from parley.operators import lookup as L
from parley.operators.common import broadcast_if_small

IGNORE = -100
DIRECTIONS = ("zh2en", "en2zh")


def _map_side(vmap: DataFrame, src: str, dst: str) -> DataFrame:
    m = vmap.select(F.col(src).alias("_k"), F.col(dst).alias("_v"))
    return broadcast_if_small(m, L.MAX_MAP_ROWS)


# ---------------------------------------------------------------- J1 / J2 / SQ1 / SQ2
def remap_ids(df: DataFrame, ids_col: str, vmap: DataFrame, key: str = "ex_id",
              unk: int | None = None, out_col: str | None = None, inverse: bool = False) -> DataFrame:
    """SQ1 / J1 (or SQ2 / J2 with ``inverse``): (key, out_col array<int>) for every input row, on a batch or a stream.

    OOV policy: drop (``unk=None``) or replace by ``unk``. Null, empty and all-OOV rows give []. ``inverse`` maps new -> old and
    raises on an unknown new id.
    """
    out_col = out_col or ids_col
    return with_remapped(df.select(key, F.col(ids_col).alias(out_col)), {out_col: out_col}, vmap, unk, inverse)


def with_remapped(df: DataFrame, columns: dict[str, str], vmap: DataFrame, unk: int | None = None, inverse: bool = False) -> DataFrame:
    """``df`` with each of ``columns`` (input: output) remapped; the map is compiled once for all of them."""
    src, dst = ("new_id", "old_id") if inverse else ("old_id", "new_id")
    lookup = L.compile_lookup(vmap, src, dst)
    if lookup is None:
        for c, out in columns.items():
            df = L.mapped_by_blocks(df, c, vmap, src, dst, out, unk, inverse)
        return df
    none = F.array().cast("array<int>")
    return df.withColumns({out: F.coalesce(L.mapped(F.col(c), lookup, unk, inverse), none) for c, out in columns.items()})


def remap_ids_arrow(df: DataFrame, ids_col: str, vmap: DataFrame, unk: int | None = None,
                    out_col: str | None = None, inverse: bool = False, key: str | None = None) -> DataFrame:
    """SQ1 / SQ2 as a further (or replaced) column of ``df``, with the rules of ``remap_ids``."""
    return with_remapped(df, {ids_col: out_col or ids_col}, vmap, unk, inverse)


# ---------------------------------------------------------------- PF16 / PF17
def direction_tag(direction) -> Column:
    """PF16: '[zh2en]' / '[en2zh]'; any other direction raises."""
    d = F.col(direction) if isinstance(direction, str) else direction
    return F.when(d.isin(*DIRECTIONS), F.concat(F.lit("["), d, F.lit("]"))).otherwise(
        F.raise_error(F.concat(F.lit("unknown direction "), F.coalesce(d, F.lit("null")))).cast("string"))


def quarantine_directions(df: DataFrame, direction: str = "direction"):
    """Split rows with an unknown direction out instead of raising: (good, bad)."""
    ok = F.coalesce(F.col(direction).isin(*DIRECTIONS), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def render_prompt(src, direction) -> Column:
    """PF17: "{src}\\n[direction]\\n"."""
    s = F.col(src) if isinstance(src, str) else src
    return F.concat(s, F.lit("\n"), direction_tag(direction), F.lit("\n"))


# ---------------------------------------------------------------- SQ4 / SQ5
def assemble_labels(prompt_ids, target_ids) -> tuple[Column, Column]:
    """SQ4: input = prompt + target; labels = -100 on every prompt position, then target."""
    p = F.col(prompt_ids) if isinstance(prompt_ids, str) else prompt_ids
    t = F.col(target_ids) if isinstance(target_ids, str) else target_ids
    return F.concat(p, t), F.concat(F.array_repeat(F.lit(IGNORE), F.size(p)), t)


def build_examples(df: DataFrame, vmap: DataFrame, tok: Tokenizer, eos_new_id: int,
                   max_len: int = 256, key: str = "ex_id", unk: int | None = None) -> DataFrame:
    """SQ5: render, encode, map, append eos, assemble, cut the tail to ``max_len``, row by row on a batch or a stream.

    Output (key, input_ids, labels) in new-id space.
    """
    enc = df.select(key, tok.encode(render_prompt("src", "direction")).alias("_p"), tok.encode(F.col("tgt")).alias("_t"))
    m = with_remapped(enc, {"_p": "_p", "_t": "_t"}, vmap, unk)
    t = F.concat(F.col("_t"), F.array(F.lit(int(eos_new_id))))
    inp, lab = assemble_labels(F.col("_p"), t)
    return m.select(key, F.slice(inp, 1, max_len).alias("input_ids"), F.slice(lab, 1, max_len).alias("labels"))


# ---------------------------------------------------------------- SQ7 / SQ6
def choose_oov_id(vmap: DataFrame, eos_old: int, unk_old: int | None, pad_old: int | None) -> tuple[int, int]:
    """SQ7: (eos_new, oov_new). eos must be mapped; oov = first of unk, pad that is
    mapped and is not eos; else 0. Looks up at most three ids."""
    want = [i for i in (eos_old, unk_old, pad_old) if i is not None]
    got = {r["old_id"]: r["new_id"] for r in vmap.filter(F.col("old_id").isin(want)).collect()}
    if eos_old not in got:
        raise ValueError("eos is not in the keep set")
    eos_new = got[eos_old]
    for cand in (unk_old, pad_old):
        if cand is not None and cand in got and got[cand] != eos_new:
            return eos_new, got[cand]
    return eos_new, 0


def export_remap(df: DataFrame, vmap: DataFrame, oov_new: int, key: str = "ex_id",
                 inputs: str = "input_ids", labels: str = "labels") -> DataFrame:
    """SQ6: length-preserving remap: inputs OOV -> oov id; labels keep -100, else map, else oov."""
    lookup = L.compile_lookup(vmap, "old_id", "new_id")
    none = F.array().cast("array<int>")
    if lookup is not None:
        return df.select(key, *[F.coalesce(L.kept_length(F.col(c), lookup, oov_new, IGNORE), none).alias(c) for c in (inputs, labels)])
    marked = vmap.select("old_id", "new_id").unionByName(vmap.sparkSession.sql(f"select {IGNORE} as old_id, {IGNORE} as new_id"))
    out = df.select(key, *[F.transform(c, lambda x: F.coalesce(x, F.lit(-(1 << 31)))).alias(c) for c in (inputs, labels)])  # null ids are unknown ones
    for c in (inputs, labels):
        out = L.mapped_by_blocks(out, c, marked, "old_id", "new_id", c, oov_new)
    return out


def oov_hits(df: DataFrame, vmap: DataFrame, labels: str = "labels") -> DataFrame:
    """AG8: label positions (not -100) whose old id is not in the map, counted row by row."""
    lookup = L.compile_lookup(vmap, "old_id", "new_id")
    if lookup is not None:
        c = df.select(L.unknown_counts(F.col(labels), lookup, IGNORE).alias("_c"))
        return c.agg(*[F.coalesce(F.sum(f"_c.{x}"), F.lit(0)).alias(name) for x, name in (("tok", "target_tokens"), ("oov", "oov_hits"))])
    ex = df.select(F.explode(labels).alias("_k")).filter(F.col("_k") != IGNORE)
    j = ex.join(_map_side(vmap, "old_id", "new_id"), "_k", "left")
    return j.agg(F.count(F.lit(1)).alias("target_tokens"), F.count_if(F.col("_v").isNull()).alias("oov_hits"))


# ---------------------------------------------------------------- SQ11
def target_positions(labels) -> Column:
    """SQ11: positions p >= 1 with labels[p] != -100 (0-based)."""
    lab = F.col(labels) if isinstance(labels, str) else labels
    n = F.size(lab)
    return F.when(n <= 1, F.array().cast("array<int>")).otherwise(
        F.filter(F.sequence(F.lit(1), n - 1), lambda p: F.get(lab, p) != IGNORE))


# ---------------------------------------------------------------- PF15 / AG3 / W10
def token_oov(df: DataFrame, vmap: DataFrame, tok: Tokenizer, text: str = "tgt",
              keep: Sequence[str] = ("ex_id", "direction")) -> DataFrame:
    """Long form (keep..., pos, token_id, oov) of a text column against the map (PF15)."""
    ex = df.select(*keep, F.posexplode(tok.encode(F.col(text))).alias("pos", "token_id"))
    m = _map_side(vmap, "old_id", "new_id").select(F.col("_k").alias("token_id"), F.lit(False).alias("_in"))
    j = ex.join(m, "token_id", "left")
    return j.select(*keep, "pos", "token_id", F.col("_in").isNull().alias("oov"))


def oov_report(df: DataFrame, vmap: DataFrame, tok: Tokenizer, text: str = "tgt",
               direction: str = "direction", key: str = "ex_id") -> DataFrame:
    """AG3: per direction: rows with >= 1 token, tokens, OOV tokens, first-token OOV, rates.

    Counted row by row through the compiled map; a map beyond the bound is joined with the long form, where a row with at least one
    token has exactly one position 0, so no distinct count is needed.
    """
    lookup = L.compile_lookup(vmap, "old_id", "new_id")
    if lookup is not None:
        t = df.select(direction, L.unknown_counts(tok.encode(F.col(text)), lookup).alias("_c")).filter("_c.tok > 0")
        g = t.groupBy(direction).agg(F.count(F.lit(1)).alias("n"), F.sum("_c.tok").alias("tok"), F.sum("_c.oov").alias("oov"),
                                     F.count_if("_c.first").alias("first_oov"))
    else:
        t = token_oov(df, vmap, tok, text, keep=(key, direction))
        g = t.groupBy(direction).agg(F.count_if(F.col("pos") == 0).alias("n"), F.count(F.lit(1)).alias("tok"), F.count_if("oov").alias("oov"),
                                     F.count_if((F.col("pos") == 0) & F.col("oov")).alias("first_oov"))
    return g.select(direction, "n", "tok", "oov", "first_oov",
                    (F.lit(100.0) * F.col("oov") / F.greatest(F.lit(1), F.col("tok"))).alias("oov_pct"),
                    (F.lit(100.0) * F.col("first_oov") / F.greatest(F.lit(1), F.col("n"))).alias("first_oov_pct"))


def first_oov_samples(df: DataFrame, vmap: DataFrame, tok: Tokenizer, n: int, order_by: Sequence[str],
                      text: str = "tgt", direction: str = "direction", width: int = 50) -> DataFrame:
    """First ``n`` rows (global order) whose first target token is OOV."""
    first = df.select(*order_by, *([direction] if direction not in order_by else []),
                      F.col(text).alias("_t"), F.get(tok.encode(F.col(text)), 0).alias("token_id"))
    first = first.filter(F.col("token_id").isNotNull())
    m = _map_side(vmap, "old_id", "new_id").select(F.col("_k").alias("token_id"))
    bad = first.join(m, "token_id", "left_anti")
    return bad.orderBy(*order_by).limit(n).select(*order_by, *([direction] if direction not in order_by else []),
                                                  cut("_t", width).alias(text), "token_id")
