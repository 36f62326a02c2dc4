"""Token ids in a compressed binary format: static range asymmetric numeral system.

File format (one row per block in a Parquet folder, plus one folder with the table):

``model/``   ``symbol``, ``freq``: the shared frequency table of all blocks; the
             frequencies of the symbols that occur sum to 2**SCALE_BITS.
``blocks/``  ``part``, ``part_offset`` (ids before the block in its part), ``n_tokens``,
             ``doc_ids``, ``doc_tokens`` (documents of the block, in order), ``words``
             (little-endian 32-bit code words), ``states`` (little-endian 64-bit coder
             states of every lane at every checkpoint), ``cursors`` (place in ``words``
             at every checkpoint), ``crc32`` (of the ids as little-endian 32-bit).

A block holds whole documents and is coded on its own.  Its ids are laid out in rows of
``LANES``; every lane is a coder of its own and all lanes share one stream of words, so
a row is coded with a few numpy operations.  Every ``CHECKPOINT_ROWS`` rows the states
and the place in the stream are kept: from there a reader can decode without the rows
before, and ``decode_block`` decodes all checkpointed stretches side by side.

Parts are ranges of ``doc_id`` in ascending order (repeated ids in row order, null ids
first), so the files hold all ids in that order.  ``write`` runs: ids to a scratch table,
one sum per symbol, one range shuffle of the ids, blocks.  ``read`` needs the blocks and
the sums per part only.  Defined cases: a null or empty text holds just the end id, an
empty table gives empty folders and reads back empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordlens.llm.common import batch_slices, scratch, ship, table
from wordlens.llm.tokens import encoder

SCALE_BITS = 20
LOW = np.uint64(1 << 31)          # a state is kept in [2**31, 2**63)
LANES = 2048
CHECKPOINT_ROWS = 128
BLOCK_TOKENS = 1 << 20
PART_TOKENS = 64 * BLOCK_TOKENS

IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
BLOCKS = pa.schema([
    ("part", pa.int32()), ("part_offset", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("words", pa.binary()), ("states", pa.binary()), ("cursors", pa.list_(pa.int64())), ("crc32", pa.int64())])
BLOCKS_DDL = ("part int, part_offset long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
              "words binary, states binary, cursors array<long>, crc32 long")


# ---- the coder -------------------------------------------------------------------

class Model:
    """Frequencies, their running sums, and the symbol of every slot."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        n = int(symbols.max()) + 1 if len(symbols) else 1
        self.freq = np.zeros(n, np.uint64)
        self.freq[symbols] = freqs
        self.before = np.cumsum(self.freq) - self.freq
        self.slots = np.repeat(np.arange(n, dtype=np.uint32), self.freq.astype(np.int64))


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to a sum of 2**bits, at least 1 each; the largest take the rest."""
    total = int(counts.sum())
    if len(counts) > 1 << bits:
        raise ValueError("more symbols than slots")
    out = np.maximum(1, np.round(counts.astype(np.float64) / max(1, total) * (1 << bits))).astype(np.int64)
    rest = (1 << bits) - int(out.sum())
    for i in np.argsort(-counts, kind="stable"):
        if rest >= 0:
            out[i] += rest
            break
        step = min(-rest, int(out[i]) // 2)
        out[i] -= step
        rest += step
    return out


def encode_block(ids: np.ndarray, model: Model, lanes: int = LANES, every: int = CHECKPOINT_ROWS) -> tuple[bytes, bytes, list[int]]:
    """(words, states, cursors) of one block; rows are coded from the last to the first."""
    bits, mask = np.uint64(SCALE_BITS), np.uint64(0xFFFFFFFF)
    rows = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, states, marks, written = [], [], [], 0
    for row in range(rows - 1, -1, -1):
        part = ids[row * lanes:(row + 1) * lanes]
        x = state[:len(part)]
        freq, before = model.freq[part], model.before[part]
        over = x >= (freq << np.uint64(63 - SCALE_BITS))
        if over.any():
            out = x[over]
            words.append((out & mask).astype("<u4"))
            written += len(out)
            x[over] = out >> np.uint64(32)
        quotient = x // freq
        x += (quotient << bits) - quotient * freq + before
        if row % every == 0:
            states.append(state.astype("<u8").tobytes())
            marks.append(written)
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    # read from the front: a checkpoint's cursor counts the words that come before it
    return stream.tobytes(), b"".join(states[::-1]), [written - m for m in marks[::-1]]


def decode_block(words: bytes, states: bytes, cursors: list[int], n: int, model: Model,
                 lanes: int = LANES, every: int = CHECKPOINT_ROWS) -> np.ndarray:
    """Ids of a block; all checkpointed stretches are decoded side by side."""
    if not n:
        return np.zeros(0, np.uint32)
    bits, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
    stream = np.frombuffer(words, "<u4").astype(np.uint64)
    state = np.frombuffer(states, "<u8").astype(np.uint64).reshape(len(cursors), lanes)
    place = np.array(cursors, np.int64)
    rows = -(-n // lanes)
    out = np.zeros((len(cursors), every, lanes), np.uint32)
    for step in range(every):
        live = np.flatnonzero(np.arange(len(cursors)) * every + step < rows)
        if not len(live):
            break
        x = state[live]
        slot = x & mask
        symbol = model.slots[slot.astype(np.int64)]
        x = model.freq[symbol] * (x >> bits) + slot - model.before[symbol]
        low = x < LOW
        width = n - (rows - 1) * lanes          # the last row may be short: its idle lanes hold no code
        final = live * every + step == rows - 1
        if width < lanes and final.any():
            low[final, width:] = False
        need = low.sum(1)
        at = (place[live] + need)[:, None] - need[:, None] + (np.cumsum(low, 1) - 1)
        x[low] = (x[low] << np.uint64(32)) | stream[at[low]]
        place[live] += need
        state[live] = x
        out[live, step] = symbol
    return out.reshape(-1)[:n]


# ---- the jobs --------------------------------------------------------------------

def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """``doc_id`` and the ids of the text with the end id, as bytes (16 bits an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        if code.library.get_vocab_size() > 1 << 16:
            raise ValueError("the scratch table keeps ids in 16 bits")
        for batch in batches:
            for part in batch_slices(batch, 1):
                ids, counts = code.encode(part.column(1).to_pylist())
                ends = np.cumsum(counts)
                data = memoryview(np.insert(ids, ends, end_id).astype("<u2").tobytes())
                upto = np.concatenate([[0], np.cumsum(counts + 1)]) * 2
                yield table(IDS, doc_id=part.column(0),
                            ids=[data[p:q] for p, q in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)])

    return ship(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        # the ids of all rows of a batch lie one after the other
        ids = batch.column(0)
        upto = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
        if len(ids) and upto[-1] > upto[0]:
            data = np.frombuffer(ids.buffers()[2], "<u2", (int(upto[-1]) - int(upto[0])) // 2, int(upto[0]))
            counts += np.bincount(data, minlength=1 << 16)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], ["symbol", "count"])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, parts: int | None = None) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) into the folder ``path``."""
    spark = docs.sparkSession
    ids = scratch(token_ids(docs, tokenizer, end_id).withColumn("_rid", F.monotonically_increasing_id()), "ids")
    # one row per symbol of the vocabulary, at most 2**16
    counts = (ids.select("ids").mapInArrow(_count, "symbol int, count long")
              .groupBy("symbol").agg(F.sum("count").alias("count")).toPandas().sort_values("symbol"))
    symbols, freqs = counts["symbol"].to_numpy(np.int64), scaled(counts["count"].to_numpy(np.int64)) if len(counts) else np.zeros(0, np.int64)
    spark.createDataFrame(list(zip(symbols.tolist(), freqs.tolist(), strict=True)), "symbol int, freq long").coalesce(1).write.parquet(f"{path}/model")
    model = spark.sparkContext.broadcast((symbols, freqs))
    total = int(counts["count"].sum())
    # large parts, so that their bounds stay few; smaller ones where that leaves cores idle
    parts = parts or max(1, -(-total // PART_TOKENS), min(total // (2 * BLOCK_TOKENS), 2 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, offset = Model(*model.value), 0, 0
        docs_: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs_, held, size, offset
            flat = np.concatenate(held)
            words, states, cursors = encode_block(flat, coder)
            row = table(BLOCKS, part=[part], part_offset=[offset], n_tokens=[size], doc_ids=[docs_],
                        doc_tokens=[[len(x) for x in held]], words=[words], states=[states], cursors=[cursors],
                        crc32=[zlib.crc32(flat.astype("<u4").tobytes())])
            offset += size
            docs_, held, size = [], [], 0
            return row

        for batch in batches:
            for doc, data, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = number
                one = np.frombuffer(data, "<u2").astype(np.int64)
                docs_.append(doc)
                held.append(one)
                size += len(one)
                if size >= BLOCK_TOKENS:
                    yield flush()
        if held:
            yield flush()

    (ship(ids).repartitionByRange(parts, F.asc_nulls_first("doc_id"), "_rid").sortWithinPartitions(F.asc_nulls_first("doc_id"), "_rid")
     .select("doc_id", "ids", F.spark_partition_id().alias("part"))
     .mapInArrow(run, BLOCKS_DDL).write.option("compression", "none").parquet(f"{path}/blocks"))


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode the files: one row per document (``doc_id``, ``start``, ``n_tokens``,
    ``ids_crc32`` and, if asked for, ``ids`` as little-endian 32-bit bytes)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    rows = spark.read.parquet(f"{path}/model").toPandas()  # one row per symbol of the vocabulary
    model = spark.sparkContext.broadcast((rows["symbol"].to_numpy(np.int64), rows["freq"].to_numpy(np.int64)))
    # ids before each part: one row per part
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    placed = blocks.join(F.broadcast(starts), "part").select(
        (F.col("part_start") + F.col("part_offset")).alias("start"), "n_tokens", "doc_ids", "doc_tokens", "words", "states", "cursors", "crc32")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                       + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Model(*model.value)
        for batch in batches:
            for i in range(batch.num_rows):
                b = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                data = decode_block(b["words"], b["states"], b["cursors"], b["n_tokens"], coder).astype("<u4").tobytes()
                if zlib.crc32(data) != b["crc32"]:
                    raise ValueError("block checksum differs")
                upto = np.concatenate([[0], np.cumsum(b["doc_tokens"])])
                view = memoryview(data)
                docs_ = [view[4 * p:4 * q] for p, q in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
                more = {"ids": docs_} if with_ids else {}
                yield table(schema, doc_id=b["doc_ids"], start=b["start"] + upto[:-1], n_tokens=b["doc_tokens"],
                            ids_crc32=[zlib.crc32(d) for d in docs_], **more)

    return ship(placed).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
