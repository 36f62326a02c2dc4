"""Toxicity by compression distance: two zstandard dictionaries, compared window by window.

A text is cut into windows of ``WORDS`` lower-case words.  Each window is compressed with a
dictionary of ordinary text and with one of toxic text; the bytes that the toxic one saves
are the window's gain.  The toxic dictionary is made of what tells toxic text apart (see
``contrast``), followed by the same ordinary text as the other one, so that a window without
such parts compresses alike with both and chance matches do not add up over long texts.
A fast pair of compressors with short dictionaries looks at every window; the windows in
which it finds a gain are measured by a slow pair with long ones, and only that gain counts.

Learning uses labelled rows outside the held-out fold only, and of these a bounded sample:
``toxic_docs`` and ``ordinary_docs`` documents (those with the smallest hash of the id) and
``doc_windows`` windows of each (smallest hash).  Dictionaries learn from documents whose id's
crc32 leaves 0 or 1 by 4, thresholds are calibrated on whole texts of as many that leave 3,
the classes weighted as among all such labels: a logistic model of
three features of a whole text, shifted so that ``CUT`` is the score with the best F1 there.

Jobs: one pass over ``docs`` for the sample's windows, one for the calibration features, one
to score every whole text (no shuffle).  What reaches the driver is bounded by the three
parameters.  Defined cases: a null or empty text has no window and gets the score of gain
zero; a null id is not held out; repeated rows are scored each; words of over ``LONGEST``
bytes are cut; repeated labels of one id count as toxic if any is; null labels are ignored;
without toxic labels every gain is zero.  Other columns of ``docs`` are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import batch_slices, scratch, ship, table

WORDS = 24
LONGEST = 256              # bytes of a word that stays whole
SPACE = " \t\n\r\x0b\x0c"     # where bytes.split() cuts
SLICE = 1 << 18            # characters of a text handled at once
GRAMS = (6, 8)             # bytes of the parts that are counted
CUT = 0.3                  # score from which a text is called toxic
HELD_OUT, CALIBRATE = 2, 3  # remainders of crc32(id) by 4

FAST = dict(strategy=zstandard.STRATEGY_GREEDY, min_match=6, search_log=4)
SLOW = dict(strategy=zstandard.STRATEGY_BTOPT, min_match=5)
FAST_BYTES, ORDINARY_BYTES, TOXIC_BYTES = 1024, 16384, 4096


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, by 4 (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


# ---- windows ---------------------------------------------------------------------

def _words(text: str) -> Iterator[bytes]:
    """Lower-case words as bytes, long ones cut; only a slice of the text is split at once."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end - 1] not in SPACE and end - at < 2 * SLICE:
            end += 1
        for word in text[at:end].lower().encode().split():
            if len(word) <= LONGEST:
                yield word
            else:
                yield from (word[i:i + LONGEST] for i in range(0, len(word), LONGEST))
        at = end


def windows(text: str | None) -> Iterator[bytes]:
    """Runs of ``WORDS`` words with a space before each word and one at the end."""
    held: list[bytes] = []
    for word in _words(text or ""):
        held.append(word)
        if len(held) == WORDS:
            yield b" " + b" ".join(held) + b" "
            held = []
    if held:
        yield b" " + b" ".join(held) + b" "


# ---- dictionaries ----------------------------------------------------------------

def _grams(some: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all windows with room between them, starts and codes of the parts of ``size`` bytes)."""
    room = b"\0" * 12
    flat = np.frombuffer(room + b"".join(w + room for w in some), np.uint8)
    lengths = np.fromiter(map(len, some), np.int64, len(some))
    begins = np.cumsum(lengths + len(room)) - lengths
    inside = np.zeros(len(flat) + 1, np.int64)
    np.add.at(inside, begins, 1)
    np.add.at(inside, np.maximum(begins, begins + lengths - size + 1), -1)
    return flat, np.flatnonzero(np.cumsum(inside)[:-1] > 0), lengths


def _codes(flat: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``size`` bytes from every place as one number (size up to 8)."""
    out = np.zeros(len(at), np.uint64)
    for i in range(size):
        out = (out << np.uint64(8)) | flat[at + i].astype(np.uint64)
    return out


def _contexts(some: list[bytes], size: int, wanted: np.ndarray | None = None, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Parts and the number of different surroundings (8 bytes before, 4 after) of each: a
    passage that is copied from text to text counts once.  Only the ``wanted`` parts, or
    those found at ``least`` so many times."""
    flat, at, _ = _grams(some, size)
    code = _codes(flat, at, size)
    if wanted is None:
        wanted, n = np.unique(code, return_counts=True)
        wanted = wanted[n >= least]
    kept = np.isin(code, wanted)
    at, code = at[kept], code[kept]
    around = _codes(flat, at - 8, 8) * np.uint64(0x9E3779B97F4A7C15) ^ _codes(flat, at + size, 4) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.lexsort((around, code))
    code, around = code[order], around[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (around[1:] != around[:-1])
    return np.unique(code[new], return_counts=True)


def contrast(toxic: list[bytes], ordinary: list[bytes], parts: int = 400, least: int = 4, ratio: float = 5.0, sigma: float = 3.0) -> bytes:
    """The text that tells toxic windows apart, most frequent last: stretches covered by the
    ``parts`` parts whose different surroundings exceed by most what ordinary text lets
    expect (at least ``least``, ``ratio`` times and ``sigma`` deviations as many)."""
    if not toxic:
        return b""
    share = sum(map(len, toxic)) / max(1, sum(map(len, ordinary)))
    found = []
    for size in GRAMS:
        code, n = _contexts(toxic, size, least=least)
        code, n = code[n >= least], n[n >= least]
        other, m = _contexts(ordinary, size, code) if ordinary else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        at = np.minimum(np.searchsorted(other, code), max(0, len(other) - 1))
        plain = np.where(other[at] == code, m[at], 0) if len(other) else np.zeros(len(code), np.int64)
        expected = (plain + 0.3) * share
        z = (n - expected) / np.sqrt(expected + 1)
        some = np.flatnonzero((n >= ratio * expected) & (z >= sigma))
        found += [(float(z[i]), size, int(code[i])) for i in some]
    best = sorted(found, reverse=True)[:parts]
    stretches: Counter[bytes] = Counter()
    hit = None
    for size in GRAMS:
        flat, at, _ = _grams(toxic, size)
        mark = np.zeros(len(flat) + 1, np.int64) if hit is None else hit
        picked = at[np.isin(_codes(flat, at, size), np.array([c for _, s, c in best if s == size], np.uint64))]
        np.add.at(mark, picked, 1)
        np.add.at(mark, picked + size, -1)
        hit = mark
    covered = np.concatenate([[0], (np.cumsum(hit)[:-1] > 0).view(np.int8), [0]])
    edges = np.flatnonzero(np.diff(covered))
    data = flat.tobytes()
    stretches.update(data[a:b][:16] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
    return b"".join(s for s, n in sorted(stretches.items(), key=lambda x: (x[1], x[0])) if n >= 2)[-TOXIC_BYTES:]


def ordinary_text(some: list[bytes]) -> bytes:
    """A trained dictionary of ordinary windows (few windows: the windows themselves)."""
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, some).as_bytes()
    except zstandard.ZstdError:
        return b"".join(some)[-ORDINARY_BYTES:]


def compressor(content: bytes, settings: dict) -> zstandard.ZstdCompressor:
    if len(content) < 8:                                     # the library takes no shorter one
        content = content.ljust(8)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    setup = zstandard.ZstdCompressionParameters.from_level(
        15, source_size=256, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0, **settings)
    data.precompute_compress(compression_params=setup)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=setup)


@dataclass
class Model:
    """Contents of both dictionaries, weights of the features, shift of the score."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=lambda: [-2.0, 0.0, 0.0, 0.0])
    _pairs: list | None = None

    def __getstate__(self):
        return {**self.__dict__, "_pairs": None}

    def pairs(self) -> list[tuple]:
        if self._pairs is None:
            self._pairs = [(compressor(self.toxic + self.ordinary[-n:], how), compressor(self.ordinary[-n:], how))
                           for how, n in ((FAST, FAST_BYTES), (SLOW, ORDINARY_BYTES))]
        return self._pairs

    def gains(self, text: str | None) -> tuple[int, int, int]:
        """(sum of the gains, largest gain, windows) of a whole text."""
        (t1, o1), (t2, o2) = self.pairs()
        total = most = n = 0
        for w in windows(text):
            n += 1
            if len(t1.compress(w)) < len(o1.compress(w)) and (gain := len(o2.compress(w)) - len(t2.compress(w))) > 0:
                total += gain
                most = max(most, gain)
        return total, most, n

    def scores(self, gains: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(gains) @ np.array(self.weights), -30, 30)))


def features(gains: np.ndarray) -> np.ndarray:
    """Rows of (1, gain a window, gain over the root of the windows, largest gain)."""
    total, most, n = gains.astype(np.float64).reshape(-1, 3).T
    n = np.maximum(n, 1)
    return np.stack([np.ones(len(n)), np.log1p(4 * total / n), np.log1p(total / np.sqrt(n)), np.minimum(most, 12) / 4], axis=1)


def calibrated(gains: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> list[float]:
    """Logistic weights (ridge, Newton steps), none below zero for a gain, shifted so that
    the score ``CUT`` is where F1 is best on these rows."""
    x, y = features(gains), toxic.astype(np.float64)
    used = list(range(x.shape[1]))
    while True:
        w, own = np.zeros(len(used)), x[:, used]
        ridge = np.diag([1e-3, *[0.5] * (len(used) - 1)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            w += np.clip(np.linalg.solve(own.T @ (own * (weight * p * (1 - p))[:, None]) + ridge, own.T @ (weight * (y - p)) - ridge @ w), -5, 5)
        lowest = int(np.argmin([0.0, *w[1:]]))
        if not lowest:
            break
        used.pop(lowest)
    full = np.zeros(x.shape[1])
    full[used] = w
    w = full
    if y.sum() >= 5:
        z = x @ w
        order = np.argsort(-z, kind="stable")
        hits = np.cumsum((weight * y)[order])
        f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * y).sum())
        # only places where the score changes can be cut; the cut lies between two scores
        at = np.flatnonzero(np.append(np.diff(z[order]) < -1e-12, True))
        best = at[np.argmax(f1[at])]
        low = z[order[best + 1]] if best + 1 < len(y) else z[order[best]] - 1
        w[0] += np.log(CUT / (1 - CUT)) - (z[order[best]] + low) / 2
    return w.tolist()


# ---- the jobs --------------------------------------------------------------------

def labelled_ids(labels: DataFrame) -> DataFrame:
    """``_id``, ``_toxic`` (0 or 1), ``_fold`` of every labelled id outside the held-out fold."""
    some = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    some = some.where(F.col("_id").isNotNull() & F.col("_toxic").isNotNull()).groupBy("_id").agg((F.max("_toxic") > 0).cast("int").alias("_toxic"))
    return some.withColumn("_fold", fold(F.col("_id")).cast("int")).where(F.col("_fold") != HELD_OUT)


def sample_ids(ids: DataFrame, toxic_docs: int, ordinary_docs: int) -> DataFrame:
    """At most toxic_docs and ordinary_docs ids to learn from, and as many to calibrate with."""
    out = None
    for calibrate in (False, True):
        for toxic, most in ((1, toxic_docs), (0, ordinary_docs)):
            some = ids.where((F.col("_toxic") == toxic) & ((F.col("_fold") == CALIBRATE) == calibrate)).orderBy(F.xxhash64("_id"), "_id").limit(most)
            out = some if out is None else out.unionByName(some)
    return out


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = 1000, ordinary_docs: int = 3000, doc_windows: int = 32) -> Model:
    """Dictionaries and thresholds learnt from labelled rows (see the module's text)."""
    every = labelled_ids(labels)
    ids = scratch(sample_ids(every, toxic_docs, ordinary_docs), "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"))
    # the ids are at most 2 * (toxic_docs + ordinary_docs) rows, so they may go to every task
    chosen = texts.join(F.broadcast(ids), F.col("_doc") == F.col("_id")).select("_toxic", "_fold", "_text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("toxic", pa.int32()), ("window", pa.binary())])
        for batch in batches:
            for part in batch_slices(batch, 2):
                toxic, _, text = (c.to_pylist() for c in part.columns)
                rows = [(y, w) for y, t in zip(toxic, text, strict=True)
                        for w in heapq.nsmallest(doc_windows, windows(t), key=lambda w: (xxhash.xxh3_64_intdigest(w), w))]
                if rows:
                    yield table(schema, toxic=[y for y, _ in rows], window=[w for _, w in rows])

    learn = ship(chosen.where(F.col("_fold") != CALIBRATE)).mapInArrow(cut, "toxic int, window binary").toPandas()
    # in one order whatever the tasks' order was, and each window once
    sets = [sorted({bytes(w) for w in learn["window"][learn["toxic"] == y]}, key=lambda w: (xxhash.xxh3_64_intdigest(w), w)) for y in (0, 1)]
    model = Model(contrast(sets[1], sets[0]), ordinary_text(sets[0]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("toxic", pa.int32()), ("total", pa.int64()), ("most", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            for part in batch_slices(batch, 2):
                found = np.array([shared.value.gains(t) for t in part.column(2).to_pylist()], np.int64).reshape(-1, 3)
                yield table(schema, toxic=part.column(0), total=found[:, 0], most=found[:, 1], n=found[:, 2])

    rows = ship(chosen.where(F.col("_fold") == CALIBRATE)).mapInArrow(measure, "toxic int, total long, most long, n long").toPandas()
    rows = rows.sort_values(["toxic", "total", "most", "n"])
    if len(rows):
        # the classes weigh as much as among all rows to calibrate with (two counts)
        counted = {r["_toxic"]: r["count"] for r in every.where(F.col("_fold") == CALIBRATE).groupBy("_toxic").count().collect()}
        drawn = rows["toxic"].value_counts()
        weight = rows["toxic"].map({y: max(1, counted.get(y, 1)) / n for y, n in drawn.items()}).to_numpy(np.float64)
        model.weights = calibrated(rows[["total", "most", "n"]].to_numpy(), rows["toxic"].to_numpy(), weight / weight[rows["toxic"].argmax()])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch_slices(batch, 2):
                model_ = shared.value
                found = model_.scores(np.array([model_.gains(t) for t in part.column(2).to_pylist()], np.int64))
                yield table(schema, doc_id=part.column(0), held_out=part.column(1), score=found, predicted=(found >= CUT).astype(np.int32))

    ids = F.col("doc_id").cast("long")
    rows = docs.select(ids.alias("_id"), F.coalesce(fold(ids) == HELD_OUT, F.lit(False)).alias("_held"), F.col("text").cast("string").alias("_text"))
    return ship(rows).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
