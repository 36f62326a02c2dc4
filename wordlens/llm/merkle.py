"""Merkle manifest of a dataset: one tree per source and one over the sources.

A leaf is the digest of a row.  In a tree every ``FANOUT`` consecutive nodes (the last run:
fewer, even one) become the digest of their joined digests, until one node remains.  The
tree of a source has its rows as leaves, by document id; the tree over the sources has the
roots of theirs.

Layout.  A tree is stored in aligned blocks of ``LEVELS`` levels of nodes, one row each: a
block is a subtree over up to ``FANOUT ** (LEVELS - 1)`` consecutive nodes, and the roots of
blocks are the leaves of the blocks above (``store`` recurses over them until every tree is
one block).  Inside a block the digests lie in van Emde Boas order: the levels are cut at half
height, the top subtree comes first, then the bottom subtrees one after the other, each laid
out in the same way.  ``address`` gives a node's place from its depth and number alone, for
writing a block and for reading the siblings of a path; no pointers are kept, and a path
touches few neighbouring stretches whatever the size of a page or cache line.

Jobs
1. *Leaves*: digests of every row as it is, and of the row as it may have been changed
   (narrow, no Python; texts go no further than this).
2. *Numbers*: a range sort of (source, id, digest) rows; the place of a row in its source is
   its place in its partition plus the rows of the source in the partitions before, so a
   source of any size is spread over many tasks.
3. *Blocks*: leaves are grouped by (tree, number // block), at most a block in a group.
4. *Paths*: from the top down, each block's rows meet the block (a grouped join) and take
   the siblings on their way and those above the block; rows with theirs are folded again.

Defined cases: a null id comes first in its source and is never changed; equal ids go by
digest, equal rows share every digest; a null source is a source; null text stays null;
an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlens.llm.common import drop_scratch, scratch, ship

FANOUT = 3
LEVELS = 8                                  # levels of nodes in a block: 2,187 leaves
DIGEST = 32


# ---- layout ----------------------------------------------------------------------

def capacity(levels: int) -> int:
    """Leaves of a block."""
    return FANOUT ** (levels - 1)


def nodes(levels: int) -> int:
    """Nodes of a complete tree with so many levels."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def address(depth: np.ndarray | int, number: np.ndarray, levels: int) -> np.ndarray:
    """Places in van Emde Boas order of the nodes ``number`` (from 0) of a level, ``depth``
    levels below the root of a complete tree with ``levels`` levels."""
    number = np.asarray(number, np.int64)
    if levels == 1:
        return np.zeros(number.shape, np.int64)
    top = levels // 2
    if depth < top:
        return address(depth, number, top)
    under = FANOUT ** (depth - top)          # nodes of this level in each bottom subtree
    return nodes(top) + number // under * nodes(levels - top) + address(depth - top, number % under, levels - top)


@cache
def level_places(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(FANOUT ** depth), levels)


def digest_of(run: list[bytes]) -> bytes:
    """Digest of digests, which are joined as hexadecimal text."""
    return sha256(b"".join(d.hex().encode() for d in run)).digest()


def build(leaves: list[bytes], levels: int) -> bytes:
    """A block over ``leaves`` with ``levels`` levels of nodes, in van Emde Boas order."""
    out = np.zeros((nodes(levels), DIGEST), np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        out[level_places(depth, levels)[:len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, DIGEST)
        if depth:
            row = [digest_of(row[i:i + FANOUT]) for i in range(0, len(row), FANOUT)]
    return out.tobytes()


def path(block: bytes, leaf: int, width: int, levels: int) -> list[tuple[list[bytes], list[bytes]]]:
    """Siblings before and after the path from leaf ``leaf`` of ``width`` to the block's
    root, level by level."""
    out = []
    for depth in range(levels - 1, 0, -1):
        first = leaf - leaf % FANOUT
        run = np.arange(first, min(first + FANOUT, width))
        digests = [block[p:p + DIGEST] for p in (address(depth, run, levels) * DIGEST).tolist()]
        out.append((digests[:leaf - first], digests[leaf - first + 1:]))
        leaf //= FANOUT
        width = -(-width // FANOUT)
    return out


def fold(leaf: bytes, siblings: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for before, after in siblings:
        leaf = digest_of([*before, leaf, *after])
    return leaf


def height(leaves: int) -> int:
    """Levels of nodes of a tree over so many leaves."""
    levels = 1
    while leaves > 1:
        leaves = -(-leaves // FANOUT)
        levels += 1
    return levels


# ---- paths as bytes: for every level the number of siblings before and after, then these

def path_bytes(siblings: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    return b"".join(bytes([len(a), len(b)]) + b"".join(a) + b"".join(b) for a, b in siblings)


def path_of(data: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(data):
        a, b = data[at], data[at + 1]
        at += 2
        digests = [data[at + i * DIGEST:at + (i + 1) * DIGEST] for i in range(a + b)]
        at += (a + b) * DIGEST
        out.append((digests[:a], digests[a:]))
    return out


# ---- 1: leaves -------------------------------------------------------------------

def leaf_digest(values: list[Column]) -> Column:
    """Digest of values: ``-`` for null, else the UTF-8 bytes' count, a colon and the value."""
    def part(v: Column) -> Column:
        text = v.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.unhex(F.sha2(F.concat(*map(part, values)).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """``_id``, ``_source``, ``_leaf`` and ``_seen``: the digest of the row as it is found
    later, null where it is the same."""
    name = lambda c: F.col(f"`{c}`")
    rows = docs.select(*[name(c).alias(f"_{c}") for c in ("doc_id", "source", "lang", "n_chars", "text")])
    own = ["_doc_id", "_source", "_lang", "_n_chars"]
    text = F.col("_text").cast("string")
    changed = F.coalesce(F.crc32(F.col("_doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)) & F.coalesce(F.contains(text, F.lit("\n")), F.lit(False))
    return rows.select(
        # as text: a null among numbers would turn them into floats on their way to Python
        F.col("_doc_id").cast("long").cast("string").alias("_id"), F.col("_source").cast("string").alias("_source"),
        leaf_digest([*map(F.col, own), text]).alias("_leaf"),
        F.when(changed, leaf_digest([*map(F.col, own), F.replace(text, F.lit("\n"), F.lit(""))])).alias("_seen"))


# ---- 2: numbers ------------------------------------------------------------------

def placed(rows: DataFrame, group: list[str], order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``_n``, their place (from 0) in their group, and ``_of``, the group's
    size; a written table.  No task holds more than its share of a group."""
    by = [F.asc_nulls_first(c) for c in group] + order
    sorted_ = scratch(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_mid", F.monotonically_increasing_id()), label)
    part = F.shiftright("_mid", 33)
    counts = sorted_.groupBy(*group, part.alias("_part")).agg(F.min("_mid").alias("_from"), F.count("*").alias("_rows"))
    # of a group: one row for each partition that holds some of it
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"{c}_") for c in group], "_part", "_from", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy(*group)).alias("_of"))
    same = part == F.col("_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return sorted_.join(counts, same).select(*rows.columns, (F.col("_mid") - F.col("_from") + F.col("_before")).alias("_n"), "_of")


# ---- 3: blocks -------------------------------------------------------------------

def store(numbered: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Blocks of trees, lowest first, from rows (``_tree``, ``_n``, ``_of``, ``_leaf``): written
    tables of ``_tree``, ``_block``, ``_of`` (leaves of the whole level), ``_nodes``, ``_root``."""
    def make(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_n")
        of = int(group["_of"].iloc[0])
        data = build([bytes(x) for x in group["_leaf"]], min(levels, height(of)))
        return pd.DataFrame({"_tree": [group["_tree"].iloc[0]], "_block": [int(group["_n"].iloc[0]) // size], "_of": [of], "_nodes": [data], "_root": [data[:DIGEST]]})

    size = capacity(levels)
    out: list[DataFrame] = []
    rows = numbered.select("_tree", "_n", "_of", "_leaf")
    while True:
        blocks = scratch(ship(rows).groupBy("_tree", F.expr(f"_n div {size}").alias("_b")).applyInPandas(
            make, "_tree long, _block long, _of long, _nodes binary, _root binary"), "blocks")
        out.append(blocks)
        above = F.ceil(F.col("_of") / F.lit(size)).cast("long")
        rows = blocks.where(F.col("_of") > size).select("_tree", F.col("_block").alias("_n"), above.alias("_of"), F.col("_root").alias("_leaf"))
        if rows.isEmpty():
            return out


def roots(blocks: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """``_tree`` and its ``_root``: trees end at the level where they are one block."""
    tops = [b.where(F.col("_of") <= capacity(levels)).select("_tree", "_root") for b in blocks]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


# ---- 4: paths --------------------------------------------------------------------

def _meet(rows: DataFrame, blocks: DataFrame, levels: int, run, schema: str) -> DataFrame:
    """Rows (``_tree``, ``_n``, ...) and their blocks, group by group."""
    left = ship(rows).withColumn("_b", F.expr(f"_n div {capacity(levels)}")).groupBy("_tree", "_b")
    return left.cogroup(blocks.withColumn("_b", F.col("_block")).groupBy("_tree", "_b")).applyInPandas(run, schema)


def _siblings(block: pd.DataFrame, n: int, levels: int) -> list[tuple[list[bytes], list[bytes]]]:
    one = block.iloc[0]
    first = int(one["_block"]) * capacity(levels)
    return path(one["_nodes"], n - first, min(capacity(levels), int(one["_of"]) - first), min(levels, height(int(one["_of"]))))


def block_paths(blocks: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """For every lowest block ``_tree``, ``_block``, ``_path``: the siblings from its root to the
    last root; ``above`` gives ``_tree`` and ``_up``, what follows a tree's own root."""
    def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rest = bytes(block["_path"].iloc[0])
        return pd.DataFrame({"_tree": rows["_tree"], "_block": rows["_n"], "_path": [path_bytes(_siblings(block, int(n), levels)) + rest for n in rows["_n"]]})

    known = None
    for level in range(len(blocks) - 1, -1, -1):
        own = blocks[level].where(F.col("_of") <= capacity(levels)).join(above, "_tree").select("_tree", "_block", F.col("_up").alias("_path"))
        if known is not None:
            parents = blocks[level + 1].join(known, ["_tree", "_block"])
            lower = blocks[level].where(F.col("_of") > capacity(levels)).select("_tree", F.col("_block").alias("_n"))
            own = own.unionByName(_meet(lower, parents, levels, run, "_tree long, _block long, _path binary"))
        known = scratch(own, "paths")
    return known


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``,
    ``verified`` for every row."""
    rows = scratch(leaves(docs), "leaves")
    if rows.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    # sources are numbered in their order; a tree is named by the number of its source
    sources = placed(rows.select("_source").distinct().withColumn("_all", F.lit(0)), ["_all"], [F.asc_nulls_first("_source")], "sources").select(
        F.col("_source").alias("_name"), F.col("_n").alias("_tree"), F.col("_of").alias("_sources"))
    in_order = placed(rows, ["_source"], [F.asc_nulls_first(F.col("_id").cast("long")), F.col("_leaf")], "sorted")
    numbered = scratch(in_order.join(sources, F.col("_source").eqNullSafe(F.col("_name"))).select("_tree", "_n", "_of", "_id", "_leaf", "_seen"), "numbered")
    drop_scratch(rows)
    low = store(numbered, levels)
    subroots = roots(low, levels)
    number = sources.agg(F.max("_sources")).first()[0]
    high = store(subroots.select(F.lit(0).cast("long").alias("_tree"), F.col("_tree").alias("_n"), F.lit(number).cast("long").alias("_of"), F.col("_root").alias("_leaf")), levels)
    root = bytes(roots(high, levels).first()["_root"])
    whole = block_paths(high, docs.sparkSession.createDataFrame([(0, bytearray())], "_tree long, _up binary"), levels)

    def climb(rows_: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rest = bytes(block["_path"].iloc[0])
        return pd.DataFrame({"_tree": rows_["_n"], "_up": [path_bytes(_siblings(block, int(n), levels)) + rest for n in rows_["_n"]]})

    subs = subroots.select(F.lit(0).cast("long").alias("_tree"), F.col("_tree").alias("_n"))
    up = scratch(_meet(subs, high[0].join(whole, ["_tree", "_block"]), levels, climb, "_tree long, _up binary"), "up")
    of_blocks = block_paths(low, up, levels)

    def prove(rows_: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        above = path_of(bytes(block["_path"].iloc[0]))
        proofs, folded = [], []
        for n, leaf, seen in zip(rows_["_n"], rows_["_leaf"], rows_["_seen"], strict=True):
            way = _siblings(block, int(n), levels) + above
            proofs.append(digest_of([d for before, after in way for d in [*before, *after]]).hex())
            folded.append(fold(bytes(leaf if seen is None else seen), way).hex())
        return pd.DataFrame({"_id": rows_["_id"], "leaf": [bytes(x).hex() for x in rows_["_leaf"]],
                             "subroot": bytes(block["_subroot"].iloc[0]).hex(), "root": root.hex(), "proof_sha256": proofs,
                             "folded_root": folded, "verified": [x == root.hex() for x in folded]})

    ends = subroots.select(F.col("_tree").alias("_t"), F.col("_root").alias("_subroot"))
    lowest = low[0].join(of_blocks, ["_tree", "_block"]).join(ends, F.col("_tree") == F.col("_t")).drop("_t")
    proved = _meet(numbered, lowest, levels, prove,
                   "_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return proved.select(F.col("_id").cast("long").alias("doc_id"), *proved.columns[1:])
