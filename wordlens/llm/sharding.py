"""K-d tree sharding: split at exact weighted medians along the widest dimension.

A node of the tree holds ``k`` of the shards.  It is split along the metadata dimension
in which its rows spread widest (of the whole table's spread), at the point that leaves
``floor(k/2)/k`` of its bytes on the left, until every leaf is one shard, that is, holds
the target ``total bytes / shards``.

The medians are found without sorting: a row's key in a dimension is its position there
(24 bits of the table's range) with 24 bits of a hash behind it, so that rows with one
value, even a third of the table, can be parted anywhere.  Three passes of a grouped sum
over 16 key bits each narrow the point down, for all nodes of a level at once; a pass
returns at most 2**16 sums per node and the driver sees one row per node.  All passes
read a written table of a few narrow columns, never the texts.

A row larger than the mean of what is left (at most one per shard) is taken out first and
gets a shard of its own, so that no shard stays empty beside it.

Slots are gapless in a shard without a sort of whole shards: rows are numbered within
hash buckets of a few thousand, and buckets start after those before them.

Everything is DataFrame operations.  Defined cases: a null, NaN or infinite position
counts as the smallest; null or negative sizes raise; repeated rows are dealt one by one;
with fewer rows than shards some shards stay empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlens.llm.common import scratch

POSITION_BITS, HASH_BITS, DIGIT_BITS = 24, 24, 16


def text_position(text: Column) -> Column:
    """A number that orders strings by their first six bytes."""
    padded = F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("double")


def shard(rows: DataFrame, size: Column, dimensions: list[Column], shards: int, bucket_rows: int = 4096) -> DataFrame:
    """``rows`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in a shard)."""
    own = {c: f"_in{i}" for i, c in enumerate(rows.columns)}
    weight = size.cast("long")
    checked = F.when(weight >= 0, weight).otherwise(F.raise_error(F.lit("size is null or negative")).cast("long"))
    positions = [F.when(F.abs(d.cast("double")) < float("inf"), d.cast("double")).alias(f"_p{i}") for i, d in enumerate(dimensions)]
    base = rows.select(*(F.col(c).alias(n) for c, n in own.items()), checked.alias("_size"), *positions,
                       F.monotonically_increasing_id().alias("_uid"))
    base = scratch(base, "shard")
    dims = range(len(dimensions))
    whole = base.agg(F.count("*").alias("n"), F.sum("_size").alias("bytes"),
                     *(f(f"_p{i}").alias(f"{n}{i}") for i in dims for f, n in ((F.min, "lo"), (F.max, "hi")))).first()
    hash_ = F.xxhash64("_uid").bitwiseAND(F.lit((1 << HASH_BITS) - 1))

    def key(i: int) -> Column:
        lo, hi = whole[f"lo{i}"] or 0.0, whole[f"hi{i}"] or 0.0
        spread = (hi - lo) or 1.0
        place = F.floor((F.coalesce(F.col(f"_p{i}"), F.lit(lo)) - lo) / spread * ((1 << POSITION_BITS) - 1)).cast("long")
        return (F.shiftleft(place, HASH_BITS) + hash_).alias(f"_k{i}")

    # a row above the mean of what is left gets a shard of its own: at most one row per shard is looked at
    alone, left = [], whole["bytes"] or 0
    for r in base.select("_uid", "_size").orderBy(F.col("_size").desc(), "_uid").limit(shards).collect():
        if shards - len(alone) < 2 or r["_size"] * (shards - len(alone)) <= left:
            break
        alone.append(r["_uid"])
        left -= r["_size"]
    others = base.where(~F.col("_uid").isin(alone)) if alone else base
    placed = others.select("_uid", "_size", *(key(i) for i in dims), F.lit(1).cast("long").alias("_node"))
    parts, numbers = {1: shards - len(alone)}, {1: 0}       # per node: its number of shards and its first one
    while any(k > 1 for k in parts.values()):
        placed, parts, numbers = _split(placed, parts, numbers, len(dimensions))
    leaf = _values(placed, "node long, shard int", [(n, numbers[n]) for n in parts])
    placed = placed.join(F.broadcast(leaf), F.col("_node") == F.col("node")).select("_uid", "shard")
    if alone:
        placed = placed.unionByName(_values(placed, "_uid long, shard int", [(u, shards - 1 - i) for i, u in enumerate(alone)]))
    # rows are numbered within buckets of a shard
    buckets = max(1, -(-whole["n"] // (shards * bucket_rows)))
    placed = placed.withColumn("_bucket", F.pmod(F.xxhash64("_uid", F.lit("slot")), F.lit(buckets)))
    count = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = count.select("shard", "_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_uid"))
    slots = (placed.withColumn("_rank", rank).join(starts, ["shard", "_bucket"])
             .select(F.col("_uid").alias("_u"), "shard", (F.col("_start") + F.col("_rank") - 1).alias("slot")))
    clash = {"shard", "slot"}
    return base.join(slots, F.col("_uid") == F.col("_u")).select(
        *(F.col(n).alias(c) for c, n in own.items() if c not in clash), "shard", "slot")


def _values(like: DataFrame, schema: str, rows: list[tuple]) -> DataFrame:
    """A literal table (one row per node of the tree)."""
    names = [x.split()[0] for x in schema.split(", ")]
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows]
    one = like.sparkSession.range(1).select(F.explode(F.array(*structs)).alias("r"))
    return one.select(*(F.col(f"r.{x.split()[0]}").cast(x.split()[1]).alias(x.split()[0]) for x in schema.split(", ")))


def _split(placed: DataFrame, parts: dict[int, int], numbers: dict[int, int], dims: int) -> tuple[DataFrame, dict, dict]:
    """One level of the tree, for all nodes that still hold more than one shard."""
    extent = [(F.max(F.shiftright(f"_k{i}", HASH_BITS)) - F.min(F.shiftright(f"_k{i}", HASH_BITS))).alias(f"e{i}") for i in range(dims)]
    found = {r["_node"]: r for r in placed.groupBy("_node").agg(F.sum("_size").alias("bytes"), *extent).collect()}  # a row per node
    # node -> (dimension, bytes wanted on the left, key digits found so far)
    state = {}
    for node, k in parts.items():
        if k > 1 and node in found:
            r = found[node]
            widest = max(range(dims), key=lambda i: (r[f"e{i}"], -i))
            state[node] = [widest, r["bytes"] * (k // 2) // k, 0]
    bits = POSITION_BITS + HASH_BITS
    for done in range(0, bits, DIGIT_BITS):
        if not state:
            break
        plan = _values(placed, "node long, dim int, want long, prefix long", [(n, *s) for n, s in state.items()])
        chosen = F.element_at(F.array(*(f"_k{i}" for i in range(dims))), F.col("dim") + 1)
        rows = placed.join(F.broadcast(plan), F.col("_node") == F.col("node")).select("node", "want", "prefix", "_size", chosen.alias("key"))
        rows = rows.where(F.shiftright("key", bits - done) == F.col("prefix"))
        digit = F.shiftright("key", bits - done - DIGIT_BITS).alias("digit")
        sums = rows.groupBy("node", "want", digit).agg(F.sum("_size").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("digit"))
        # the digit in which the wanted bytes are reached: at most 2**16 sums per node are ranked
        reach = sums.withColumn("upto", upto).where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("w") <= F.col("want")))
        hit = reach.groupBy("node").agg(F.min_by(F.struct("digit", "upto", "w"), F.col("digit")).alias("r")).collect()  # a row per node
        for r in hit:
            s, x = state[r["node"]], r["r"]
            rest = s[1] - (x["upto"] - x["w"])
            # in the last digit, its rows go to the side that leaves the smaller error
            last = done + DIGIT_BITS >= bits
            s[1], s[2] = rest, x["digit"] + (1 if last and 2 * rest > x["w"] else 0)
    new_parts, new_numbers = {}, {}
    for node, k in parts.items():
        left = k // 2
        if k > 1:
            new_parts |= {2 * node: left, 2 * node + 1: k - left}
            new_numbers |= {2 * node: numbers[node], 2 * node + 1: numbers[node] + left}
        else:
            new_parts[2 * node], new_numbers[2 * node] = 1, numbers[node]
    if state:
        plan = F.broadcast(_values(placed, "node long, dim int, split long", [(n, s[0], s[2]) for n, s in state.items()]))
        chosen = F.element_at(F.array(*(f"_k{i}" for i in range(dims))), F.col("dim") + 1)
        right = F.coalesce((chosen >= F.col("split")).cast("long"), F.lit(0).cast("long"))
        placed = placed.join(plan, F.col("_node") == F.col("node"), "left").withColumn("_node", 2 * F.col("_node") + right).drop("node", "dim", "split")
    else:
        placed = placed.withColumn("_node", 2 * F.col("_node"))
    return placed, new_parts, new_numbers
