"""Line dedup by an exact set-similarity join over the lines of all documents.

A line is the set of its words (lower case); two lines match if the Jaccard similarity of
their sets is at least ``threshold``.  Of a match the later line goes (order: document id,
row, line number), whether or not the earlier one stays.

Jobs
1. *Lines*: number, place and 64-bit content hash of every line with a word (narrow rows).
2. *Rarity*: words that make up at least 1/(``FINER`` ``common``) of all words are counted, in
   the pass that reads the lines, and
   sent to the tasks: by that share there are at most ``FINER`` ``common`` of them.  All other
   words are rarer; among themselves they are ordered by hash.  Any order of words gives the
   same matches; the finer it is, the fewer lines meet in vain.
3. *Postings*: each task cuts its new lines to their prefix (the rarest words; a match of
   ``t`` shares one of the first ``|x| - ceil(t |x|) + 1``) and sends (word and size in one
   number, line, size and position in one, signature).  Postings meet by word, ordered by
   size: a sort by one number.  Words are split, told apart and hashed by the column, not
   one by one in Python; a task streams through
   them, holds only the sizes that the length filter still admits, and applies the length
   filter, the positional filter (words after the shared one bound the overlap) and a bound
   from 128-bit signatures.  It returns star edges of candidate lines, not pairs.
4. *Components* of candidates; only their lines' words are fetched: a sketch of 8 MB tells
   the tasks which lines to send, and a join by hash leaves the wanted ones.
5. *Verification*: the lines of a component are compared through an inverted index in
   numpy, in blocks of ``block_lines`` (each pair of blocks of a larger component is a
   group of its own).  All matches of a line are counted and its earliest one is kept.

So a group of thousands of near copies costs comparisons, but never a row per pair.

Defined cases: null and empty texts have no lines; a line without a word is never
removed; a line of any length counts, so repeated one-word lines match; repeated rows are
documents of their own; a null document id comes after all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import batch_slices, numbered, ranges, scratch, ship, table, under_own_names, with_row_id
from wordlens.llm.components import components, local_roots

LINES = pa.schema([("_rid", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])
POSTINGS = pa.schema([("word", pa.int64()), ("h", pa.int64()), ("place", pa.int64()), ("sig", pa.int64()), ("sig2", pa.int64())])
WORDS = pa.schema([("h", pa.int64()), ("words", pa.list_(pa.int64()))])
MIX = np.uint64(0x9E3779B97F4A7C15)
MOST_COUNTED = 300_000     # different words a task counts between two reports
SEEN_LINES = 200_000       # hashes a task remembers so as to send a line's postings once
FINER = 5                  # part of 1/common down to which words are ordered by count
MOST_PAIRS = 1_000_000     # candidate pairs held before they are cut to star edges
MOST_CELLS = 1 << 20       # pairs of lines, and shared words of pairs, counted at once


def plain_lines(text: str | None) -> Iterator[tuple[int, str]]:
    """Number and text of every line with a word, lower case and without outer space."""
    for n, line in enumerate(text.lower().split("\n") if text else ()):
        if line := line.strip():
            yield n, line


def content_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def content_hashes(some: list[str]) -> np.ndarray:
    """``content_hash`` of every line."""
    digests = np.fromiter(map(xxhash.xxh3_64_intdigest, some), np.uint64, len(some))
    return (digests ^ np.uint64(1 << 63)).view(np.int64)


def word_sets(some: list[str]) -> pa.ListArray:
    """The set of every line's words as sorted 64-bit hashes; each different word is hashed once."""
    counts, index, different = coded_words(some)
    words = different.to_pylist()
    key, rank = np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64), return_inverse=True)
    owner, rank = distinct(counts, rank[index])
    ends = np.cumsum(np.bincount(owner, minlength=len(some)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(key[rank]))


def distinct(counts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and rank of the different words of every text, in that order; ``rank`` holds the
    ranks of all words, ``counts`` of them for every text."""
    at = np.sort((np.repeat(np.arange(len(counts)), counts) << 32) | rank)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])[:len(at)]]
    return at >> 32, at & 0xFFFFFFFF


def least_overlap(a, b, threshold: float):
    """Shared words that sets of these sizes need (numbers or arrays)."""
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


# ---- 1 and 2: lines and rarity -------------------------------------------------------------------

SHORT = 64                 # bytes of the words that are hashed together
CHUNK = 1 << 16            # bytes of words hashed at once
BASE = 0x9E3779B97F4A7C13  # odd, so it has an inverse modulo 2**64
_POWERS, _INVERSES = (np.cumprod(np.array([1] + [x] * CHUNK, np.uint64)) for x in (BASE, pow(BASE, -1, 1 << 64)))
_LETTERS = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], np.uint64)


def split_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of every text (split as ``str.split`` does), the index of every word
    among the different ones, and the hashes of those."""
    counts, index, different = coded_words(texts)
    return counts, index, hashes(different)


def coded_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.LargeStringArray]:
    """``split_words`` with the different words themselves."""
    split = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    counts = np.diff(split.offsets.to_numpy())
    coded = split.flatten().dictionary_encode()
    index, different = coded.indices.to_numpy(), coded.dictionary
    if (void := pc.index(different, pa.scalar("", different.type)).as_py()) >= 0:     # around outer space
        owner = np.repeat(np.arange(len(texts)), counts)[index != void]
        counts, index = np.bincount(owner, minlength=len(texts)), index[index != void]
    return counts, index, different


def hashes(words: pa.LargeStringArray) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial of random numbers for its bytes, from sums
    over the bytes of all words; words longer than ``SHORT`` bytes one by one."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out = np.zeros(len(words), np.uint64)
    first = 0
    while first < len(words):
        end = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
        place = at[first:end + 1] - at[first]
        if place[-1] <= CHUNK:     # else one long word
            sums = np.zeros(int(place[-1]) + 1, np.uint64)
            np.cumsum(_LETTERS[letters[at[first]:at[end]]] * _POWERS[:place[-1]], out=sums[1:])
            out[first:end] = (sums[place[1:]] - sums[place[:-1]]) * _INVERSES[place[:-1]]
        first = end
    out = (out ^ (out >> np.uint64(32))) * MIX
    for i in np.flatnonzero(np.diff(at) > SHORT).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words[i].as_py())
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def lines_and_words(numbered_docs: DataFrame, common: int) -> tuple[DataFrame, dict[int, int]]:
    """Of rows with ``_rid``, in one pass over the texts: a written table of ``_rid``, ``doc_id``,
    ``line`` (number in the text) and ``h`` of lines with a word; and the counts of the words
    (by hash) with a share of at least 1/common: at most ``common`` words.  A line that a task
    has just read is not counted again: only different lines have postings.

    A task reports the words that have that share in what it read since its last report,
    so counts lack less than 1/common of all words and the report of a task is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged(more: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            key = np.concatenate([words, *(w for w, _ in more)])
            n = np.concatenate([counts, *(n for _, n in more)])
            order = np.argsort(key)
            key = key[order]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
            return key[new], np.add.reduceat(n[order], new) if len(new) else n

        def flush() -> pa.RecordBatch:
            total = int(counts.sum())
            often = counts * common >= total
            # the row without a word has the number of words read
            word = pa.array(np.concatenate([[0], words[often]]), mask=np.arange(often.sum() + 1) == 0)
            long, short = pa.nulls(len(word), pa.int64()), pa.nulls(len(word), pa.int32())
            return table(LINES, _rid=long, doc_id=long, line=short, h=word, n=np.concatenate([[total], counts[often]]))

        seen: set[int] = set()
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in batch_slices(batch, 2):
                split = [list(plain_lines(text)) for text in part.column(2).to_pylist()]
                some = [line for of_text in split for _, line in of_text]
                if not some:
                    continue
                hashed = content_hashes(some)
                owner = pa.array(np.repeat(np.arange(len(split)), [len(of_text) for of_text in split]))
                yield table(LINES, _rid=part.column(0).take(owner), doc_id=part.column(1).take(owner),
                            line=[n for of_text in split for n, _ in of_text], h=hashed, n=pa.nulls(len(some), pa.int64()))
                new = {h: line for h, line in zip(hashed.tolist(), some, strict=True) if h not in seen}
                if len(seen) > SEEN_LINES:
                    seen.clear()
                seen.update(new)
                if not new:
                    continue
                _, index, word = split_words(list(new.values()))
                waiting.append((word, np.bincount(index, minlength=len(word))))
                if sum(len(w) for w, _ in waiting) > MOST_COUNTED:
                    words, counts = merged(waiting)
                    waiting.clear()
                    if len(words) > MOST_COUNTED:
                        yield flush()
                        words, counts = words[:0], counts[:0]
        words, counts = merged(waiting)
        yield flush()

    rows = numbered_docs.select("_rid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = scratch(ship(rows).mapInArrow(run, "_rid long, doc_id long, line int, h long, n long"), "lines")
    counted = scratch(read.where(F.col("n").isNotNull()).groupBy("h").agg(F.sum("n").alias("n")), "words")
    total = (counted.where(F.col("h").isNull()).first() or {"n": 0})["n"]
    often = counted.where(F.col("h").isNotNull() & (F.col("n") * common >= total))
    return read.where(F.col("n").isNull()).drop("n"), dict(often.toPandas().itertuples(index=False, name=None))


# ---- 3: postings and candidates --------------------------------------------------

SIZE_BITS = 24             # low bits of a posting's number: the size, up to MOST_SIZE
MOST_SIZE = (1 << SIZE_BITS) - 1


def by_rarity(common: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the common words, ascending, and their keys: places in the order of counts,
    then hashes, above the bits of a size."""
    place = {w: i for i, w in enumerate(sorted(common, key=lambda w: (common[w], w)))}
    words = sorted(common)
    return np.array(words, np.int64), np.array([place[w] for w in words], np.int64) << SIZE_BITS


def word_keys(words: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """64-bit keys that order words by rarity: common ones by their place, all others, rarer,
    by a hash below zero."""
    keys = (words.view(np.uint64) >> np.uint64(1)).view(np.int64) - (1 << 62) - (1 << 62)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], words), len(common[0]) - 1)
        keys = np.where(common[0][at] == words, common[1][at], keys)
    return keys


def prefixes(some: list[str], common: tuple[np.ndarray, np.ndarray], threshold: float) -> dict[str, np.ndarray]:
    """The prefix words of every line: ``owner`` (index of the line), ``word`` (key), ``pos``,
    ``size`` and the line's signature: odd or even number of words with each of 128 bits."""
    counts, index, words = split_words(some)
    key, rank = np.unique(word_keys(words, common), return_inverse=True)
    owner, rank = distinct(counts, rank[index])      # by line, then rarity
    size = np.bincount(owner, minlength=len(some))
    start = np.cumsum(size) - size
    pos = np.arange(len(owner)) - start[owner]
    bit = (key.view(np.uint64) * MIX) >> np.uint64(57)
    one = np.uint64(1) << (bit & np.uint64(63))
    sig = [np.bitwise_xor.reduceat(np.where((bit < 64) == low, one, np.uint64(0))[rank], start).view(np.int64) for low in (True, False)]
    kept = pos < (size - np.ceil(threshold * size - 1e-9) + 1)[owner]
    owner = owner[kept]
    return {"owner": owner, "word": key[rank[kept]], "size": size[owner], "pos": pos[kept], "sig": sig[0][owner], "sig2": sig[1][owner]}


def postings(docs: DataFrame, common: dict[int, int], threshold: float) -> DataFrame:
    """``word`` (key, its low bits replaced by the line's size), ``h`` (line), ``place`` (size
    and position in the line's order of rarity) and the signature.

    Words that share the other bits of a key meet too; that adds candidates at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(by_rarity(common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in batch_slices(batch, 0):
                new = {}
                for text in part.column(0).to_pylist():
                    for _, line in plain_lines(text):
                        if (h := content_hash(line)) not in seen:
                            if len(seen) > SEEN_LINES:
                                seen.clear()
                            seen.add(h)
                            new[h] = line
                if new:
                    found = prefixes(list(new.values()), shared.value, threshold)
                    yield table(POSTINGS, h=np.array(list(new), np.int64)[found["owner"]], place=found["size"] << 32 | found["pos"],
                                word=found["word"] & ~MOST_SIZE | np.minimum(found["size"], MOST_SIZE), sig=found["sig"], sig2=found["sig2"])

    return ship(docs).select(F.col("text").cast("string")).mapInArrow(run, "word long, h long, place long, sig long, sig2 long")


def admitted(x: tuple, y: tuple, threshold: float) -> np.ndarray:
    """Filters on posting columns (line, size, pos, signature halves) with one word; y is
    not larger than x and passes the length filter."""
    need = least_overlap(x[1], y[1], threshold)
    ok = np.minimum(x[1] - x[2], y[1] - y[2]) >= need                # position of the shared word
    # each differing signature bit comes from a word that is not shared
    apart = sum(np.bitwise_count((x[i] ^ y[i]).view(np.uint64)).astype(np.int64) for i in (3, 4))
    return ok & (x[1] + y[1] - apart >= 2 * need) & (x[0] != y[0])


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges that join the same lines as the pairs do."""
    ids, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = local_roots(inverse[:len(a)], inverse[len(a):], len(ids))
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def small_groups(words: np.ndarray, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs within groups of few rows, all groups at once: each row is compared
    with the one ``d`` places before it, for every d until no row has one that is in its
    group and long enough."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    found = 0
    columns = list(rows)
    size = columns[1]
    x = np.arange(len(words))
    d = 1
    while len(x):
        x = x[x >= d]
        x = x[(words[x] == words[x - d]) & (size[x - d] >= threshold * size[x] - 1e-9)]
        ok = x[admitted([c[x] for c in columns], [c[x - d] for c in columns], threshold)]
        a.append(columns[0][ok])
        b.append(columns[0][ok - d])
        d += 1
        if (found := found + len(ok)) > MOST_PAIRS:
            a, b = ([part] for part in stars(np.concatenate(a), np.concatenate(b)))
            found = 0
    return np.concatenate(a), np.concatenate(b)


class Window:
    """Postings of one word in order of size, cut to the sizes a later line may match."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.rows = np.zeros((5, 0), np.int64)       # line, size, pos, two halves of the signature

    def meet(self, new: np.ndarray, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs of the new rows with those held and with each other, as star edges."""
        held = self.rows[:, self._fitting(self.rows[1], min(int(new[1].min()), MOST_SIZE)):]
        both = np.concatenate([held, new], axis=1)
        first = held.shape[1]
        if both[1].max() > MOST_SIZE:     # their sizes do not sort them
            first, both = 0, both[:, np.argsort(both[1], kind="stable")]
        ids, inverse = np.unique(both[0], return_inverse=True)
        root = np.arange(len(ids))
        for s in range(first, both.shape[1], block):
            part = both[:, s:s + block, None]
            size = part[1]
            for o in range(self._fitting(both[1], int(size[0, 0])), s + len(size), 4 * block):
                other = both[:, None, o:min(o + 4 * block, s + len(size))]
                ok = (other[1] <= size) & (other[1] >= self.threshold * size - 1e-9)
                x, y = np.nonzero(ok & admitted(part, other, self.threshold))
                x, y = root[inverse[s + x]], root[inverse[o + y]]
                if (x != y).any():
                    root = local_roots(x[x != y], y[x != y], len(ids))[root]
        self.rows = both[:, self._fitting(both[1], min(int(both[1, -1]), MOST_SIZE)):]
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return ids[moved], ids[root[moved]]

    def _fitting(self, sizes: np.ndarray, size: int) -> int:
        """Where the sizes begin that a line of this size, or a larger one, may match."""
        return int(np.searchsorted(sizes, math.ceil(self.threshold * size - 1e-9)))


def joined(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[list[np.ndarray]]:
    """The columns of several batches at once, so that short groups share a pass."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(batch.num_columns)]
            held.clear()
    if sum(b.num_rows for b in held):
        yield [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(held[0].num_columns)]


def candidates(posted: DataFrame, threshold: float, most: int = 512) -> DataFrame:
    """Star edges (``a``, ``b``) between the lines that pass the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, window = None, Window(threshold)
        for words, h, place, sig, sig2 in joined(batches):
            words = words >> SIZE_BITS
            rows = np.stack([h, place >> 32, place & 0xFFFFFFFF, sig, sig2])
            starts = np.concatenate([[0], np.flatnonzero(np.diff(words)) + 1])
            sizes = np.diff(np.concatenate([starts, [len(words)]]))
            # words whose rows may go on in another batch, or have many rows, go through a window
            alone = (sizes > most) | (np.maximum.reduceat(rows[1], starts) > MOST_SIZE)
            alone[[0, -1]] = True
            short = np.repeat(~alone & (sizes > 1), sizes)
            pairs = [small_groups(words[short], rows[:, short], threshold)]
            for s, n in zip(starts[alone].tolist(), sizes[alone].tolist(), strict=True):
                if words[s] != word:
                    word, window = words[s], Window(threshold)
                pairs.append(window.meet(rows[:, s:s + n]))
            a, b = stars(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = posted.repartition(F.shiftright("word", SIZE_BITS)).sortWithinPartitions("word")
    return ship(dealt).mapInArrow(run, "a long, b long")


# ---- 4 and 5: verification -------------------------------------------------------

SKETCH_BITS = 26           # bits of the sketch: 8 MB, whatever the number of lines


def sketch(lines_: DataFrame) -> np.ndarray:
    """A bit for every hash ``h`` modulo 2**SKETCH_BITS: at most 2**SKETCH_BITS / 64 rows of
    64 bits are gathered."""
    place = F.col("h").bitwiseAND(F.lit((1 << SKETCH_BITS) - 1))
    rows = lines_.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (SKETCH_BITS - 6), np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


def fetch_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The word hashes of every wanted line (``h`` and more columns).  A task sends the
    lines that the sketch of wanted lines lets pass; the join leaves the wanted ones."""
    bits = docs.sparkSession.sparkContext.broadcast(sketch(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in batch_slices(batch, 0):
                split = [line for t in part.column(0).to_pylist() for _, line in plain_lines(t)]
                hashed = content_hashes(split)
                place = hashed & ((1 << SKETCH_BITS) - 1)
                passed = np.flatnonzero((bits.value[place >> 6] >> (place & 63)) & 1)
                out = {}
                for i, h in zip(passed.tolist(), hashed[passed].tolist(), strict=True):
                    if h not in seen:
                        if len(seen) > SEEN_LINES:
                            seen.clear()
                        seen.add(h)
                        out[h] = split[i]
                if out:
                    yield table(WORDS, h=list(out), words=word_sets(list(out.values())))

    some = ship(docs).select(F.col("text").cast("string")).mapInArrow(run, "h long, words array<long>")
    # a line may come from many tasks: one row of it stays
    return wanted.join(some.withColumnRenamed("h", "_h"), F.col("h") == F.col("_h")).drop("_h").dropDuplicates(["h"])


def matches(a: list[np.ndarray], b: list[np.ndarray], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For every set of ``a`` the indexes in ``b`` of the sets that match it."""
    size = np.array([len(x) for x in b])
    vocabulary, inverse = np.unique(np.concatenate(b), return_inverse=True)
    owner = np.repeat(np.arange(len(b)), size)[np.argsort(inverse, kind="stable")]
    upto = np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(vocabulary)))])
    flat = np.concatenate(a)
    at = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
    there = vocabulary[at] == flat
    # owners of every word of every set, set by set
    starts, lengths = upto[at], np.where(there, upto[at + 1] - upto[at], 0)
    sizes = np.array([len(x) for x in a])
    words = np.concatenate([[0], np.cumsum(sizes)])      # where the words of a set begin
    met = np.concatenate([[0], np.cumsum(lengths)])[words]
    first = 0
    while first < len(a):      # several sets at once, within MOST_CELLS
        end = min(len(a), first + max(1, MOST_CELLS // len(b)), max(first + 1, int(np.searchsorted(met, met[first] + MOST_CELLS, "right")) - 1))
        own = slice(words[first], words[end])
        row = np.repeat(np.arange(end - first) * len(b), met[first + 1:end + 1] - met[first:end])
        shared = np.bincount(row + owner[ranges(starts[own], lengths[own])], minlength=(end - first) * len(b))
        some = np.flatnonzero(shared)
        i, j = np.divmod(some, len(b))
        enough = shared[some] >= least_overlap(sizes[first + i], size[j], threshold)
        i, j = i[enough], j[enough]
        upto_row = np.searchsorted(i, np.arange(end - first + 1)).tolist()
        for k in range(end - first):
            yield first + k, j[upto_row[k]:upto_row[k + 1]]
        first = end


FIRST = ["f0", "f1", "f2", "f3"]     # no id, id, row, line: the order of lines


def verified(sets: DataFrame, threshold: float, block_lines: int = 4096) -> DataFrame:
    """Per line (``h``): the number of other lines it matches and the earliest of them;
    ``sets`` is a written table of ``comp``, ``h``, ``words`` and the columns FIRST."""
    sizes = sets.groupBy(F.col("comp").alias("_comp")).agg(F.ceil(F.count("*") / F.lit(block_lines)).cast("int").alias("blocks"))
    rows = sets.join(sizes, F.col("comp") == F.col("_comp")).drop("_comp")
    own = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # small components share groups of about one block, blocks of a large one meet in pairs
    many = F.lit(max(1, sets.count() // block_lines))
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), many)).otherwise(F.col("comp"))
    rows = rows.select(group.alias("g"), (F.col("blocks") > 1).alias("large"), F.least("own", "other").alias("p"),
                       F.greatest("own", "other").alias("q"), "comp", "own", "h", "words", *FIRST)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        frame = frame.sort_values(FIRST, kind="stable")     # so that the first match found is the earliest
        # the words of different components are told apart
        mixed = (frame["comp"].to_numpy().view(np.uint64) * MIX).view(np.int64)
        frame["words"] = [w ^ c for w, c in zip(frame["words"], mixed, strict=True)]
        p, q = frame["p"].iloc[0], frame["q"].iloc[0]
        left, right = frame[frame["own"] == p], frame[frame["own"] == q]
        for x, y in [(left, right)] if p == q else [(left, right), (right, left)]:
            if not len(x) or not len(y):
                continue
            mine, hashes = x["h"].to_numpy(), y["h"].to_numpy()
            first = list(y[FIRST].itertuples(index=False, name=None))
            for i, found in matches(x["words"].tolist(), y["words"].tolist(), threshold):
                found = found[hashes[found] != mine[i]]
                if len(found):
                    out.append((int(mine[i]), len(found), *first[found[0]]))
        return pd.DataFrame(out, columns=["h", "links", *FIRST])

    each = ship(rows).groupBy("g", "large", "p", "q").applyInPandas(compare, "h long, links long, f0 boolean, f1 long, f2 long, f3 int")
    return each.groupBy("h").agg(F.sum("links").alias("links"), F.min(F.struct(*FIRST)).alias("earliest"))


def line_matches(docs: DataFrame, threshold: float = 0.8, common: int = 100_000) -> DataFrame:
    """One row per line with a word: ``doc_id``, ``line`` (from 0), ``class_id`` (the same
    for lines that are equal but for case and outer space), ``n_links`` (other classes that
    match), ``removed``; and ``_rid`` (see ``with_row_id``)."""
    return matches_numbered(with_row_id(docs), threshold, common)


def matches_numbered(docs: DataFrame, threshold: float, common: int = 100_000) -> DataFrame:
    """``line_matches`` of rows that have their ``_rid``."""
    found, often = lines_and_words(docs, FINER * common)
    place = F.struct(F.col("doc_id").isNull().alias("f0"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("f1"), F.col("_rid").alias("f2"), F.col("line").alias("f3"))
    classes = scratch(found.groupBy("h").agg(F.min(place).alias("first")), "classes")
    edges = candidates(postings(docs, often, threshold), threshold)
    groups = scratch(components(edges), "candidates")
    some = classes.join(groups, F.col("h") == F.col("node")).select("h", F.col("root").alias("comp"), "first.*")
    sets = fetch_words(docs, some)
    linked = scratch(verified(scratch(sets, "sets"), threshold), "linked")
    both = classes.join(linked.withColumnRenamed("h", "_h"), F.col("h") == F.col("_h"), "left").select(
        F.col("h").alias("_h"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.least("first", "earliest"), "first").alias("earliest"))
    return found.join(both, F.col("h") == F.col("_h")).select(
        "_rid", "doc_id", "line", F.col("h").alias("class_id"), "n_links", (F.col("earliest") < place).alias("removed"))


@under_own_names
def dedup_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the later lines of every match, other columns as they are
    (``n_chars``, where there is one, counted again for changed texts)."""
    table_ = numbered(docs, "numbered")
    gone = matches_numbered(table_, threshold).where("removed").groupBy(F.col("_rid").alias("_row")).agg(F.collect_list("line").alias("_gone"))
    rows = table_.join(gone, F.col("_rid") == F.col("_row"), "left")
    text = F.array_join(F.expr("filter(split(text, '\n'), (l, i) -> not array_contains(_gone, i))"), "\n")
    changed = F.col("_gone").isNotNull()
    out = rows.withColumn("text", F.when(changed, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
