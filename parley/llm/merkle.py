"""Operator 11, Merkle dataset manifest: a nested-struct rollup over rank digits.

1. A row's leaf is the digest of its fields. Rows are numbered by (group, id, leaf) with range partitions and offsets, so a group of
   any size is spread; the number within the group is the leaf's rank, written in base 16.
2. ``DIGITS`` low digits make a block of 256 consecutive leaves. Rows are dealt out by (group, block) once; then one digit after the
   other is grouped away, each group of at most 16 rows becoming one struct that nests its children, up to one row for each block.
3. Block digests are the leaves of the next pass, 256 times smaller, until each group has one: its subroot. Subroots, ordered by
   group (null first), go through the same passes up to the root.
4. Downwards, a block's path (its runs up to the root) joins the block, one row for 256 leaves; inside a block the proofs come from
   exploding the nested structs, which hold their siblings, without a join.

A run of one node is digested too; a level is left out only where a single node remains, so a lone leaf is its own subroot. Null
fields count as ``-``. Null ids come first in their group; rows of equal id are ordered by leaf, equal rows in any order (their leaves
are the same). Empty and very long texts are digested whole in the JVM. An empty table has no rows and no root. Extra columns take no
part: only the named fields are read.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.common import broadcast_if_small, global_index

FAN = 16
BITS = 4
DIGITS = 2
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _digest_of(hashes: Column) -> Column:
    return F.sha2(F.concat_ws("", hashes), 256)


def rollup(nodes: DataFrame, digits: int = DIGITS) -> DataFrame:
    """One row for each block of FAN**digits ranks of a tree: tree, n, block, h and the nested kids.

    ``nodes`` has tree, n (nodes of the tree at this level), rank, h (hex) and further columns, which the innermost structs carry."""
    inside = [c for c in nodes.columns if c not in ("tree", "n")]
    rows = nodes.withColumn("block", F.shiftright("rank", BITS * digits))
    for i in range(digits):
        rows = rows.withColumn(f"d{i}", F.shiftright("rank", BITS * i).bitwiseAND(F.lit(FAN - 1).cast("long")).cast("int"))
    rows = rows.repartition("tree", "block")  # satisfies every grouping below
    for i in range(digits):
        child = F.struct(F.col(f"d{i}").alias("pos"), *inside)
        above = [f"d{k}" for k in range(i + 1, digits)]
        rows = rows.groupBy("tree", "n", "block", *above).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        rows = rows.withColumn("h", F.when(F.col("n") > FAN ** i, _digest_of(F.col("kids.h"))).otherwise(F.col("kids")[0]["h"]))
        inside = ["h", "kids"]
    return rows


def _climb(nodes: DataFrame, biggest: int, digits: int) -> list[DataFrame]:
    """The block tables of each pass, lowest first; in the last one every tree has one block."""
    passes = [rollup(nodes, digits).checkpoint()]
    while biggest > FAN ** digits:
        biggest = -(-biggest // FAN ** digits)
        below = passes[-1].select("tree", F.ceil(F.col("n") / FAN ** digits).cast("long").alias("n"), F.col("block").alias("rank"), "h")
        passes.append(rollup(below, digits).checkpoint())
    return passes


def _descend(blocks: DataFrame, above: DataFrame, digits: int) -> DataFrame:
    """The innermost structs of ``blocks`` as rows (tree, node), with the columns of ``above`` (tree, block, path and more) and the path down to them."""
    near = broadcast_if_small(above, BROADCAST_ROWS, BROADCAST_BYTES)
    rows = blocks.join(near, ["tree", "block"])
    carried = [c for c in above.columns if c not in ("tree", "block", "path")]
    for i in reversed(range(digits)):
        rows = rows.select("tree", "n", "path", *carried, F.col("kids.h").alias("run"), F.explode("kids").alias("node"))
        step = F.struct(F.col("node.pos").alias("pos"), F.col("run").alias("run"))
        path = F.when(F.col("n") > FAN ** i, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        rows = rows.select("tree", "n", path.alias("path"), *carried, *([F.col("node.kids").alias("kids")] if i else ["node"]))
    return rows


def _paths(passes: list[DataFrame], top: DataFrame, digits: int) -> DataFrame:
    """Rows of the lowest pass with their paths; ``top`` has tree, path and carried columns."""
    above = top.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(passes[1:]):
        rows = _descend(blocks, above, digits)
        above = rows.select(*[c for c in rows.columns if c not in ("n", "node")], F.col("node.rank").alias("block"))
    return _descend(passes[0], above, digits)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
             carry: dict[str, Column] | None = None, digits: int = DIGITS) -> DataFrame:
    """doc_id, group, leaf, subroot, root, path (array of pos and run, leaf upwards) of each row, and the ``carry`` columns."""
    carry = carry or {}
    leaves = docs.select(F.col(id_col).alias("doc_id"), F.col(group_col).alias("group"), F.unhex(leaf_digest([F.col(f) for f in fields])).alias("leaf"),
                         F.monotonically_increasing_id().alias("tie"), *[c.alias(k) for k, c in carry.items()])
    numbered = global_index(leaves, [F.asc_nulls_first("group"), F.asc_nulls_first("doc_id"), "leaf", "tie"], name="at").drop("tie")
    groups = numbered.groupBy("group").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    groups = global_index(groups, [F.asc_nulls_first("group")], name="tree").select("group", "start", "n", F.col("tree").cast("long"))
    size = groups.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("n")).first()
    near = broadcast_if_small(groups.withColumnRenamed("group", "g"), BROADCAST_ROWS, BROADCAST_BYTES)
    ranked = numbered.join(near, F.col("group").eqNullSafe(F.col("g"))).select(
        "tree", "n", (F.col("at") - F.col("start")).cast("long").alias("rank"), F.lower(F.hex("leaf")).alias("h"), "doc_id", "group", *carry)
    passes = _climb(ranked, size["n"] or 0, digits)
    subroots = passes[-1].select("tree", "h")
    over = _climb(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(size["trees"]).cast("long").alias("n"), F.col("tree").alias("rank"), "h"),
                  size["trees"], digits)
    empty = F.array().cast("array<struct<pos:int,run:array<string>>>")
    tops = _paths(over, over[-1].select("tree", F.col("h").alias("root"), empty.alias("path")), digits)
    tops = tops.select(F.col("node.rank").alias("tree"), "root", F.col("node.h").alias("subroot"), "path")
    rows = _paths(passes, tops, digits)
    return rows.select("node.doc_id", "node.group", F.col("node.h").alias("leaf"), "subroot", "root", "path", *[F.col(f"node.{c}").alias(c) for c in carry])


def siblings(step: Column) -> Column:
    """The other nodes of a run, left to right."""
    return F.concat(F.slice(step["run"], F.lit(1), step["pos"]), F.slice(step["run"], step["pos"] + 2, F.lit(FAN)))


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf upwards."""
    return F.flatten(F.transform(path, siblings))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat_ws("", F.concat(
        F.slice(p["run"], F.lit(1), p["pos"]), F.array(h), F.slice(p["run"], p["pos"] + 2, F.lit(FAN)))), 256))


def tampered_leaf(every: int = 5) -> Column:
    """The leaf of a row whose text has its A-Z lowered, for the rows whose crc32 of the decimal id is divisible by ``every``; else null."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.unhex(F.when(chosen, leaf_digest([lowered if f == "text" else F.col(f) for f in FIELDS])))


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: proofs of the rows as they are, checked on rows as tampered with."""
    rows = manifest(docs, carry={"tampered": tampered_leaf()})
    now = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", _digest_of(proof(F.col("path"))).alias("proof_sha256"), fold(now, F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
