"""Token ids of whole texts with a ``tokenizers`` file, one library call per new word.

The word-level vocabulary drops white space and never joins letters across it, so the
ids of a text are the ids of its white-space separated chunks, one after the other.
Texts repeat most chunks: a task keeps the ids of chunks it has seen (at most
``max_entries``; then it starts afresh) and asks the library for new ones only.
The tests compare the result with the library on whole texts.
"""

from __future__ import annotations

import os
import re
from itertools import chain
from string import punctuation

import numpy as np
from tokenizers import Tokenizer

from wordlens.llm.common import ranges

# str.split() also cuts at these four controls, which Unicode does not call white space.
_CONTROLS = "\x1c\x1d\x1e\x1f"
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, each other byte for
    the next free letter from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Codes(dict):
    """chunk -> dense code; remembers the chunks it had not seen."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        code = self[chunk] = len(self)
        self.new.append(chunk)
        return code


class PieceEncoder:
    """Ids of texts whose pieces are encoded one by one; pieces seen before are looked
    up (at most ``max_entries`` are kept; then it starts afresh).

    A subclass cuts a text (``chunks``) and gives the ids of new pieces (``new_ids``).
    """

    def __init__(self, max_entries: int = 400_000):
        self.max_entries = max_entries
        self._clear()

    def _clear(self) -> None:
        self.codes = _Codes()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def chunks(self, text: str) -> list[str]:
        raise NotImplementedError

    def new_ids(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(pieces in any order, number of ids of each, all ids)."""
        raise NotImplementedError

    def _learn(self) -> None:
        pieces, lengths, flat = self.new_ids(self.codes.new)
        self.codes.new = []
        more = np.zeros(len(self.codes) - len(self.start), np.int64)
        self.start, self.length = np.concatenate([self.start, more]), np.concatenate([self.length, more])
        self._store(np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces)), lengths, flat)

    def _store(self, where: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.start[where] = self.used + np.cumsum(lengths) - lengths
        self.length[where] = lengths
        self.used += len(flat)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        if len(self.codes) > self.max_entries:
            self._clear()
        parts = [self.chunks(t) if t else [] for t in texts]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        total = int(ends[-1]) if len(ends) else 0
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(parts)), np.int64, total)
        del parts
        if self.codes.new:
            self._learn()
        lengths = self.length[codes]
        ids = self.flat[ranges(self.start[codes], lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends]).astype(np.int64)]
        return ids, np.diff(upto)


class ChunkEncoder(PieceEncoder):
    """Encode texts with a white-space-dropping, lower-casing ``tokenizers`` file."""

    def __init__(self, path: str, max_entries: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.tails: dict[str, list[int]] = {"": []}
        super().__init__(max_entries)

    def chunks(self, text: str) -> list[str]:
        if any(c in text for c in _CONTROLS):
            return [c for c in _SPACE.split(text) if c]
        if "<|" not in text:  # lower-casing could make a special token of other letters
            if text.isascii() or _latin(text):  # there Python and the library agree on lower case
                text = text.lower()
        return text.split()

    def _word(self, letters: str) -> list[int]:
        """Ids of a run of lower-case Latin letters: one word for the vocabulary's model."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.library.model.tokenize(letters)]

    def _tail(self, marks: str) -> list[int]:
        """Ids of a run of ASCII punctuation."""
        if marks not in self.tails:
            if len(self.tails) > 10_000:
                self.tails = {"": []}
            self.tails[marks] = self.library.encode(marks, add_special_tokens=False).ids
        return self.tails[marks]

    def new_ids(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Runs of lower-case Latin letters go to the library's model directly; the
        punctuation after one is a piece of its own; the library encodes the rest whole."""
        ids, odd = {}, []
        for chunk in pieces:
            core = chunk.rstrip(punctuation)
            if core.isalpha() and core.islower() and (core.isascii() or _latin(core)):
                ids[chunk] = self._word(core) + self._tail(chunk[len(core):])
            else:
                odd.append(chunk)
        ids.update(zip(odd, (e.ids for e in self.library.encode_batch_fast(odd, add_special_tokens=False)), strict=True))
        return (list(ids), np.fromiter(map(len, ids.values()), np.int64, len(ids)),
                np.fromiter(chain.from_iterable(ids.values()), np.uint32))


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
