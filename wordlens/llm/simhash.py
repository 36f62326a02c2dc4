"""SimHash near-duplicates: fingerprints of word shingles and a tiled exact comparison.

Equal fingerprints are collapsed first.  The different ones are dealt by their number of
set bits and a hash into tiles of about ``tile_rows``; two fingerprints within the radius
differ in their bit counts by at most the radius, so tile pairs further apart are never
made.  A pair of tiles is one group of a grouped map: both tiles are ordered by the bit
counts of their four 16-bit quarters, cut into strips, and strips whose quarter counts
differ by more than the radius in sum are skipped (the differences of the quarters add
up to at most the number of differing bits).  All other strips are compared with numpy
exclusive-or and bit counts.  A tile pair returns each linked fingerprint with the
smallest one it reaches there, so a dense group gives rows, not pairs; ``components``
joins them over tile pairs.  No pair within the radius is missed.

Cost: the comparison is quadratic in the number of different fingerprints by its method
(about 1 ns a compared pair); what moves is each tile once per partner tile.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is
linked like any other; fewer words than a shingle: the whole sequence is one shingle;
repeated rows appear once each; a null document id is ignored by the minimum (a group of
null ids only has a null component).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import numbered, ranges, scratch, ship, table, text_slices, under_own_names, with_row_id
from wordlens.llm.components import components, local_roots

SEED = 42
STRIP = 256
# only A-Z are lowered, only these bytes separate words; both are single bytes in UTF-8
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
GAP = re.compile(rb"[\x20\x09-\x0d]+")

# for a byte: its eight bits, each in an 8-bit lane of its own
LANE_BITS = np.array([sum((v >> b & 1) << 8 * b for b in range(8)) for v in range(256)], np.uint64)

PRINTS = pa.schema([("_rid", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])


def shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.translate(LOWER).split()
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-size] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist(), strict=True)]


def fingerprints_of(texts: list[str | None], size: int = 4) -> np.ndarray:
    """A bit is set if more than half of the text's shingle hashes have it."""
    hashes, counts = [], []
    for text in texts:
        own = shingle_hashes((text or "").encode(), size)
        hashes += own
        counts.append(len(own))
    out = np.zeros(len(texts), np.uint64)
    counts_ = np.array(counts, np.int64)
    ends = np.cumsum(counts_)
    flat = np.array(hashes, np.uint64)
    some = np.flatnonzero(counts_)
    if not len(some):
        return out
    # runs of at most 255 hashes of one text: their bits are counted in 8-bit lanes
    runs = -(-counts_[some] // 255)
    cuts = np.repeat(ends[some] - counts_[some], runs) + 255 * ranges(np.zeros(len(some), np.int64), runs)
    lanes = np.zeros((len(cuts), 8), np.uint64)
    octets = flat.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes[:, k] = np.add.reduceat(LANE_BITS[octets[:, k]], cuts)
    bits = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64), np.cumsum(runs) - runs, axis=0, dtype=np.int64)
    set_ = (2 * bits > counts_[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(set_, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def fingerprints(numbered_docs: DataFrame, size: int = 4) -> DataFrame:
    """``_rid``, ``doc_id`` and ``fp`` (64 bits as a signed integer) for every row, which has its ``_rid``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for a, b in text_slices(texts):
                yield table(PRINTS, _rid=rows.slice(a, b - a), doc_id=ids.slice(a, b - a), fp=fingerprints_of(texts[a:b], size).view(np.int64))

    return ship(numbered_docs).select("_rid", F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "_rid long, doc_id long, fp long")


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two fingerprint arrays within ``radius`` bits, strip by strip."""
    def ordered(x: np.ndarray):
        quarters = np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int16)
        order = np.lexsort(quarters.T[::-1])
        quarters = quarters[order]
        cuts = np.arange(0, len(x), STRIP)
        return order, x[order], cuts, np.minimum.reduceat(quarters, cuts), np.maximum.reduceat(quarters, cuts)

    same = a is b
    a_order, a_, a_cuts, a_low, a_high = ordered(a)
    b_order, b_, b_cuts, b_low, b_high = (a_order, a_, a_cuts, a_low, a_high) if same else ordered(b)
    apart, bits = np.empty(STRIP * STRIP, np.uint64), np.empty(STRIP * STRIP, np.uint8)
    for i, start in enumerate(a_cuts):
        part = a_[start:start + STRIP, None]
        gap = np.maximum(0, np.maximum(a_low[i] - b_high, b_low - a_high[i])).sum(1)
        for j in np.flatnonzero(gap <= radius):
            if same and j < i:
                continue
            other = b_[None, b_cuts[j]:b_cuts[j] + STRIP]
            shape = len(part), other.shape[1]
            xor, count = apart[:shape[0] * shape[1]].reshape(shape), bits[:shape[0] * shape[1]].reshape(shape)
            np.bitwise_count(np.bitwise_xor(part, other, out=xor), out=count)
            found = np.flatnonzero(count <= radius)
            if len(found):
                x, y = np.divmod(found, shape[1])
                yield a_order[start + x], b_order[b_cuts[j] + y]


def linked(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest it reaches by pairs of a and b), signed, for those with a partner."""
    both, inverse = np.unique(np.concatenate([a, b]).view(np.int64), return_inverse=True)
    in_a, in_b = inverse[:len(a)], inverse[len(a):]
    root = np.arange(len(both))
    for x, y in close_pairs(a, b, radius):
        x, y = root[in_a[x]], root[in_b[y]]
        apart = x != y
        if apart.any():
            pair = np.unique(np.stack([np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])]), axis=1)
            root = local_roots(pair[0], pair[1], len(both))[root]
    moved = np.flatnonzero(root != np.arange(len(both)))
    return both[moved], both[root[moved]]


def links(distinct: DataFrame, radius: int, tile_rows: int = 16384) -> DataFrame:
    """Star edges (``a``, ``b``) that join all fingerprints (``fp``) within ``radius``."""
    tiles = distinct.select("fp", F.bit_count("fp").alias("bits"))
    sizes = tiles.groupBy("bits").agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("tiles"))  # at most 65 rows
    count = F.broadcast(sizes)
    own = tiles.join(count, "bits").select("fp", "bits", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("tile"))
    other = F.broadcast(sizes.select(F.col("bits").alias("o_bits"), F.col("tiles").alias("o_tiles")))
    # every tile goes to each tile of its own and of the bit counts up to the radius away;
    # the pair is named by the smaller (bits, tile) first
    met = own.withColumn("o_bits", F.explode(F.sequence(F.col("bits") - radius, F.col("bits") + radius))).join(other, "o_bits")
    met = met.withColumn("o_tile", F.explode(F.sequence(F.lit(0), F.col("o_tiles") - 1)))
    mine, theirs = F.struct("bits", "tile"), F.struct(F.col("o_bits").alias("bits"), F.col("o_tile").alias("tile"))
    met = met.select("fp", F.least(mine, theirs).alias("p"), F.greatest(mine, theirs).alias("q"), (mine <= theirs).alias("first"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        fp, first = group["fp"].to_numpy().view(np.uint64), group["first"].to_numpy()
        same = bool(first.all()) and group["p1"].iloc[0] == group["q1"].iloc[0] and group["p2"].iloc[0] == group["q2"].iloc[0]
        a, b = (fp, fp) if same else (fp[first], fp[~first])
        node, root = linked(a, b, radius) if len(a) and len(b) else (np.zeros(0, np.int64),) * 2
        return pd.DataFrame({"a": node, "b": root})

    flat = met.select("fp", "first", F.col("p.bits").alias("p1"), F.col("p.tile").alias("p2"), F.col("q.bits").alias("q1"), F.col("q.tile").alias("q2"))
    return ship(flat).groupBy("p1", "p2", "q1", "q2").applyInPandas(compare, "a long, b long")


def _members(numbered_docs: DataFrame, size: int, radius: int, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """(``_rid``, ``doc_id``, ``fp`` of every row; ``_fp``, ``root`` of every fingerprint)."""
    prints = scratch(fingerprints(numbered_docs, size), "prints")
    distinct = scratch(prints.select("fp").distinct(), "distinct")
    groups = scratch(components(links(distinct, radius, tile_rows)), "groups")
    return prints, distinct.join(groups, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, tile_rows: int = 16384) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` for every row of ``docs``."""
    prints, members = _members(with_row_id(docs), size, radius, tile_rows)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    placed = members.join(least, F.col("_fp") == F.col("fp")).select("_fp", "root", "least")
    ids = placed.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    of = placed.join(ids, F.col("root") == F.col("_root")).select("_fp", "component_id")
    return prints.join(of, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@under_own_names
def first_of_groups(docs: DataFrame, size: int = 4, radius: int = 4, tile_rows: int = 16384) -> DataFrame:
    """One row of each group of near-duplicates, all columns as they are: that with the
    smallest ``doc_id`` (null ids last, then the first row)."""
    table_ = numbered(docs, "numbered")
    prints, members = _members(table_, size, radius, tile_rows)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rid")
    least = prints.groupBy("fp").agg(F.min(place).alias("least"))
    kept = members.join(least, F.col("_fp") == F.col("fp")).groupBy("root").agg(F.min("least").alias("first")).select(F.col("first._rid").alias("_kept"))
    return table_.join(kept, F.col("_rid") == F.col("_kept"), "left_semi").select(*docs.columns)
