"""Byte-level byte-pair encoding and decoding by batched numpy merge rounds.

The new words of a batch lie one after the other in one flat array of symbols.  A round
finds the rank of every neighbouring pair by binary search over the sorted pair keys of
the merge list (pairs that did not change keep theirs), merges the lowest-ranked pair
of every word wherever it occurs, and closes the gaps; words without a ranked pair are
done.  Words seen before are looked up (see ``PieceEncoder``).  Decoding gathers the
bytes of all ids of a batch from one flat table.

Results equal the ``tokenizers`` library's for the same file: special tokens in the text
are cut out first, all else is split by the pattern of the byte-level vocabularies.
A null text is empty; empty texts have no ids; repeated rows are encoded each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import ranges, ship, table, text_slices
from wordlens.llm.tokens import BYTE_LETTERS, PieceEncoder

NEVER = np.int64(1 << 40)
#: characters of text encoded at once: the arrays of a slice's new words stay small
SLICE_CHARS = 200_000


class ByteBPE(PieceEncoder):
    def __init__(self, path: str, max_entries: int = 100_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.first = np.array([vocab[BYTE_LETTERS[b]] for b in range(256)], np.int64)
        letters = {c: b for b, c in BYTE_LETTERS.items()}
        tokens = {i: bytes(letters[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.byte_length = np.array([len(t) for t in ordered], np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        super().__init__(max_entries)

    def chunks(self, text: str) -> list[str]:
        if self.cut is None or not any(t in text for t in self.special):
            return self.pattern.findall(text)
        out = []
        for part in self.cut.split(text):
            # a special token's key is a tuple: the same letters elsewhere are plain text
            out += [(part,)] if part in self.special else self.pattern.findall(part)
        return out

    def new_ids(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        special = [p for p in pieces if isinstance(p, tuple)]
        words = [p for p in pieces if isinstance(p, str)]
        raw = [p.encode() for p in words]
        lengths, flat = self.merge(np.fromiter(map(len, raw), np.int64, len(raw)), np.frombuffer(b"".join(raw), np.uint8))
        return (words + special, np.concatenate([lengths, np.ones(len(special), np.int64)]),
                np.concatenate([flat, [self.special[p[0]] for p in special]]).astype(np.uint32))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER)

    def merge(self, lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words (``lengths`` bytes each, one after the other in ``data``)."""
        symbol = self.first[data]
        word = np.repeat(np.arange(len(lengths)), lengths)
        # rank[i]: of the pair of symbols i and i+1, if they are of the same word
        rank = np.full(len(symbol), NEVER)
        if len(symbol) > 1:
            rank[:-1] = np.where(word[:-1] == word[1:], self._ranks(symbol[:-1], symbol[1:]), NEVER)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            size = np.diff(np.concatenate([starts, [len(word)]]))
            going = np.repeat(least < NEVER, size)
            if not going.all():
                done.append((word[~going], symbol[~going]))
                symbol, word, rank = symbol[going], word[going], rank[going]
                if not len(symbol):
                    break
                size, least = size[least < NEVER], least[least < NEVER]
            hit = rank == np.repeat(least, size)
            # of overlapping pairs (a run of equal symbols) every other one merges
            if (hit[1:] & hit[:-1]).any():
                index = np.arange(len(hit))
                first = hit & ~np.concatenate([[False], hit[:-1]])
                hit &= (index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0
            at = np.flatnonzero(hit)
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            # pairs beside a merged symbol are looked up again
            again = np.unique(np.concatenate([place, place[place > 0] - 1]))
            rank[again] = NEVER
            again = again[again < len(symbol) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again] = self._ranks(symbol[again], symbol[again + 1])
        if not done:
            return np.zeros(len(lengths), np.int64), np.zeros(0, np.int64)
        words, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        return np.bincount(words, minlength=len(lengths)), symbols[np.argsort(words, kind="stable")]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        lengths = self.byte_length[ids]
        data = memoryview(self.bytes[ranges(self.byte_start[ids], lengths)].tobytes())
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [str(data[a:b], "utf-8", "replace") for a, b in zip(upto[:-1], upto[1:], strict=True)]


_LOADED: dict[str, ByteBPE] = {}


def loaded(path: str) -> ByteBPE:
    """One vocabulary per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian 32-bit) and the text ``decoded``
    from these ids, for every row of ``docs`` (``doc_id``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in text_slices(texts, SLICE_CHARS):
                ids, counts = bpe.encode(texts[a:b])
                data = memoryview(ids.astype("<u4").tobytes())
                upto = (4 * np.concatenate([[0], np.cumsum(counts)])).tolist()
                yield table(CODED, doc_id=doc_ids.slice(a, b - a), n_tokens=counts,
                            ids=[data[p:q] for p, q in zip(upto[:-1], upto[1:], strict=True)],
                            decoded=bpe.decode(ids, counts))

    return ship(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")
