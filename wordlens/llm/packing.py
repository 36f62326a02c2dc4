"""Best-fit packing of token pieces into sequences, by a grouping genetic algorithm.

``token_pieces`` turns texts into pieces (at most ``capacity`` ids each), ``pack`` puts
any rows with a ``length`` into as few bins as it can.

How ``pack`` works on Spark.  Rows are dealt by hash into blocks of about
``block_rows``; a block is a self-contained packing problem, so work and memory of a
task do not depend on the size of the table.  Each block is solved on several
*islands*: an island keeps a small population of groupings (bin numbers), and a child
takes whole well-filled bins of one parent, drops the other parent's bins that hold any
of the same documents, lets displaced ones take the place of held ones where that fills a
bin better, and best-fits what is left.  Between epochs the elite of
each island moves to the next island of its block (a grouped join on row number).  The
best grouping of a block stays; the rows of its bins below ``keep_fill`` are dealt anew
with those of other blocks, and what the last round leaves is kept as it is.

Defined cases: a null or empty text has just its end id; rows of any length from 1 to
``capacity`` are packed, longer, null and smaller lengths raise; repeated rows are
packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import batch_slices, scratch, ship, table
from wordlens.llm.tokens import encoder

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece of each document's ids (``doc_id``, ``text``), end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for batch in batches:
            for part in batch_slices(batch, 1):
                yield _cut(part.column(0), *code.encode(part.column(1).to_pylist()), capacity, end_id)

    return ship(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _cut(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray, capacity: int, end_id: int) -> pa.RecordBatch:
    ends = np.cumsum(counts)
    ids = np.insert(ids, ends, end_id).astype("<u4")
    counts = counts + 1
    pieces = -(-counts // capacity)
    doc = np.repeat(np.arange(len(counts)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    length = np.minimum(capacity, counts[doc] - start)
    at = (np.cumsum(counts) - counts)[doc] + start
    data = memoryview(ids.tobytes())
    crc = [zlib.crc32(data[4 * p:4 * (p + n)]) for p, n in zip(at.tolist(), length.tolist(), strict=True)]
    return table(PIECES, doc_id=doc_ids.take(pa.array(doc)), piece=piece, start=start, length=length, ids_crc32=crc)


# ---- one block -------------------------------------------------------------------

class Grouping:
    """Bins of one block: ``bins`` lists of items, with the lengths in ``size``."""

    def __init__(self, size: list[int], capacity: int, bins: list[list[int]]):
        self.size, self.capacity = size, capacity
        self.bins = [b for b in bins if b]
        self.load = [sum(size[i] for i in b) for b in self.bins]

    def best_fit(self, items: list[int]) -> None:
        """Put each item into the fullest bin with room for it, longest item first."""
        size, capacity, bins, load = self.size, self.capacity, self.bins, self.load
        room = sorted((capacity - x, b) for b, x in enumerate(load) if x < capacity)
        for i in sorted(items, key=size.__getitem__, reverse=True):
            at = bisect_left(room, (size[i], -1))
            if at < len(room):
                free, b = room.pop(at)
            else:
                free, b = capacity, len(bins)
                bins.append([])
                load.append(0)
            bins[b].append(i)
            load[b] += size[i]
            if free > size[i]:
                insort(room, (free - size[i], b))

    def exchange(self, items: list[int]) -> list[int]:
        """Let one or two of the displaced items take the place of one or two items of a bin
        where that fills the bin better (at most one exchange a bin); what is displaced then
        is returned."""
        size, out = self.size, sorted(items, key=self.size.__getitem__)
        for k, held in enumerate(self.bins):
            if len(out) < 2 or self.load[k] == self.capacity:
                continue
            free = self.capacity - self.load[k]
            lengths = np.array([size[i] for i in out])
            best = (0, (), ())                      # gain, places in the bin, places in ``out``
            n = len(held)
            for places in [(a,) for a in range(n)] + [(a, b) for a in range(n) for b in range(a)] * (n <= 8):
                gone = sum(size[held[a]] for a in places)
                room = free + gone
                one = int(np.searchsorted(lengths, room, "right")) - 1
                if one >= 0 and int(lengths[one]) - gone > best[0]:
                    best = (int(lengths[one]) - gone, places, (one,))
                # for every item the longest other one before it that still fits beside it
                other = np.minimum(np.searchsorted(lengths, room - lengths, "right"), np.arange(len(out))) - 1
                both = np.where(other >= 0, lengths + lengths[other], -1)
                both[both > room] = -1
                two = int(both.argmax())
                if both[two] - gone > best[0]:
                    best = (int(both[two]) - gone, places, (two, int(other[two])))
                if best[0] == free:
                    break
            if best[0] > 0:
                gain, places, come = best
                back = [held[a] for a in places]
                self.bins[k] = [i for a, i in enumerate(held) if a not in places] + [out[c] for c in come]
                self.load[k] += gain
                out = sorted([i for c, i in enumerate(out) if c not in come] + back, key=size.__getitem__)
        return out

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; then fill gathered in few bins."""
        return -len(self.bins), sum((x / self.capacity) ** 2 for x in self.load)


def crossover(a: Grouping, b: Grouping, rng: np.random.Generator) -> Grouping:
    """Well-filled bins of ``a`` whole, the bins of ``b`` free of their items, and the
    displaced items by best fit."""
    load = np.array(a.load)
    good = np.flatnonzero(load >= np.median(load))
    taken = [a.bins[k] for k in rng.permutation(good)[: max(1, len(good) // 2)]]
    held = {i for x in taken for i in x}
    rest, displaced = [], []
    for x in b.bins:
        if held.isdisjoint(x):
            rest.append(x)
        else:
            displaced += [i for i in x if i not in held]
    # the emptiest of what is left is broken up as well
    worst = set(np.argsort([sum(b.size[i] for i in x) for x in rest])[: 1 + len(rest) // 20].tolist()) if rest else set()
    displaced += [i for k in worst for i in rest[k]]
    child = Grouping(a.size, a.capacity, [list(x) for x in taken] + [list(x) for k, x in enumerate(rest) if k not in worst])
    child.best_fit(child.exchange(displaced))
    return child


def evolve(size: list[int], capacity: int, elites: list[list[list[int]]], seed: list[int],
           population: int, generations: int) -> Grouping:
    """The best grouping an island finds, from best fit and the elites given.

    It stops when the number of bins has reached its bound, or after ``generations``
    children in a row that bettered nothing; never after more than ten times as many.
    """
    rng = np.random.default_rng(seed)
    least = -(-sum(size) // capacity)
    pool = [Grouping(size, capacity, x) for x in elites]
    if not pool:
        first = Grouping(size, capacity, [])
        first.best_fit(list(range(len(size))))
        pool.append(first)
    while len(pool) < population:
        mixed = Grouping(size, capacity, [])
        order = rng.permutation(len(size)).tolist()
        for i in range(0, len(order), max(1, len(order) // 3)):
            mixed.best_fit(order[i:i + max(1, len(order) // 3)])
        pool.append(mixed)
    pool.sort(key=Grouping.fitness, reverse=True)
    idle = 0
    for _ in range(10 * generations):
        if len(pool[0].bins) <= least or idle >= generations:
            break
        a, b = rng.choice(len(pool), 2, replace=False)
        child = crossover(pool[min(a, b)], pool[max(a, b)], rng)
        idle += 1
        fit = child.fitness()
        if fit > pool[-1].fitness() and all(fit != other.fitness() for other in pool):
            idle = 0 if fit > pool[0].fitness() else idle
            pool[-1] = child
            pool.sort(key=Grouping.fitness, reverse=True)
    return pool[0]


def _bins(numbers: np.ndarray) -> list[list[int]]:
    order = np.argsort(numbers, kind="stable")
    cuts = np.flatnonzero(np.diff(numbers[order])) + 1
    return [x.tolist() for x in np.split(order, cuts)]


# ---- all blocks ------------------------------------------------------------------

def pack(items: DataFrame, capacity: int = 4096, block_rows: int = 4096, islands: int = 2, epochs: int = 2,
         population: int = 8, generations: int = 20, rounds: int = 3, keep_fill: float = 0.995) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (gapless from 0 in a sequence)."""
    clash = {"sequence_id", "offset"} & set(items.columns)
    own = {c: f"_in{i}" for i, c in enumerate(items.columns)}
    table_ = scratch(items.withColumnsRenamed(own).withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    size = F.col(own["length"]).cast("long")
    bad = F.raise_error(F.concat(F.lit("length out of range: "), size.cast("string")))
    todo = table_.select("_uid", F.when(size.between(1, capacity), size).otherwise(F.coalesce(bad.cast("long"), size)).alias("_size"))
    placed = None
    for turn in range(rounds):
        n = todo.count()
        if not n and placed is not None:
            break
        blocks = max(1, -(-n // block_rows))
        done = scratch(_pack_blocks(todo, turn, blocks, capacity, islands, epochs, population, generations), "packed")
        last = turn == rounds - 1 or blocks == 1
        full = F.col("_fill") >= F.lit(int(keep_fill * capacity))
        kept = done if last else done.where(full)
        kept = kept.select("_uid", F.col("_seq").alias("_sequence"), F.col("_at").alias("_offset"))
        placed = kept if placed is None else placed.unionByName(kept)
        if last:
            break
        todo = done.where(~full).select("_uid", "_size")
    back = {v: k for k, v in own.items() if k not in clash}
    return (table_.join(placed, "_uid").drop("_uid", *(own[c] for c in clash)).withColumnsRenamed(back)
            .withColumnsRenamed({"_sequence": "sequence_id", "_offset": "offset"}))


def _pack_blocks(todo: DataFrame, turn: int, blocks: int, capacity: int, islands: int, epochs: int,
                 population: int, generations: int) -> DataFrame:
    def island(epoch: int):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("_uid")
            elites = [] if group["_own"].isna().any() else [
                _bins(group[c].to_numpy(np.int64)) for c in ("_own", "_guest")]
            block, k = int(group["_block"].iloc[0]), int(group["_island"].iloc[0])
            best = evolve(group["_size"].tolist(), capacity, elites, [turn, epoch, k, block], population, generations)
            number = np.empty(len(group), np.int32)
            for b, x in enumerate(best.bins):
                number[x] = b
            return group[["_uid", "_size", "_block", "_island"]].assign(_bin=number)

        return run

    rows = todo.withColumn("_block", F.pmod(F.xxhash64("_uid", F.lit(turn)), F.lit(blocks)))
    rows = rows.withColumn("_bins", F.lit(None).cast("array<int>"))
    for epoch in range(epochs):
        lit = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("_island")
        guest = lambda step: F.col("_bins")[F.pmod(F.col("_island") + F.lit(step), F.lit(islands))]
        dealt = rows.select("_uid", "_size", "_block", "_bins", lit).select(
            "_uid", "_size", "_block", "_island", guest(0).alias("_own"), guest(-1).alias("_guest"))

        found = ship(dealt).groupBy("_block", "_island").applyInPandas(
            island(epoch), "_uid long, _size long, _block long, _island int, _bin int")
        # migration: the groupings of all islands of a block meet row by row
        rows = found.groupBy("_block", "_uid", "_size").agg(
            F.array_sort(F.collect_list(F.struct("_island", "_bin"))).alias("_all")).select(
            "_uid", "_size", "_block", F.transform("_all", lambda x: x["_bin"]).alias("_bins"))

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_uid")
        size = group["_size"].tolist()
        numbers = np.stack(group["_bins"].to_numpy())
        best = max((Grouping(size, capacity, _bins(numbers[:, k])) for k in range(numbers.shape[1])), key=Grouping.fitness)
        number, at = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        for b, x in enumerate(best.bins):
            number[x] = b
            lengths = np.array([size[i] for i in x])
            at[x] = np.cumsum(lengths) - lengths
        # sequence numbers: round, block and bin
        base = (turn << 58) + (int(group["_block"].iloc[0]) << 24)
        return group[["_uid", "_size"]].assign(_seq=base + number, _at=at, _fill=np.array(best.load)[number])

    return rows.groupBy("_block").applyInPandas(choose, "_uid long, _size long, _seq long, _at long, _fill long")
