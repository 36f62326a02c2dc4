"""Secret scan with linking of credential parts.

Strong spans (``assign``, ``access``, ``hex``) are reported wherever they occur.  Weak
candidates are parts that mean little alone: key-like strings (``secret``), user or client
identifiers (``identifier``) and host addresses (``endpoint``).  A scope is a paragraph
(text between blank lines).  Parts of one scope are joined, however far apart: a weak
candidate is reported only if its scope has parts of a complementary role, namely

* a ``secret`` with an identifier (weak or ``access``),
* an ``identifier`` with a secret (weak, ``assign`` or ``hex``),
* an ``endpoint`` with an identifier and a secret.

The join marks the roles that each scope holds, all texts of a batch at once.  It never
forms pairs, so a text with very many parts costs no more than their number.  A scope lies
in one text, hence nothing is shuffled.

A key-like string is a weak secret only if it looks random (``looks_random``): paths, slugs
and module names are not.  Inside an address it must be a value or a password.  It has any length and takes its
base64 padding along; before ``=`` and a further key character it is the name of an assignment, not a key.

Defined cases: null and empty texts have no spans; whole texts are searched; repeated
rows are searched each; a weak candidate that overlaps a strong span is left to that span;
a part belongs to the scope that it starts in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import ship, table, text_slices

# fixed patterns of the strong kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6

# weak candidates
KEY_LIKE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_-])")
IDENTIFIER = re.compile(r"""(?:user(?:name)?|login|client_?id|account(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"(?:https?|ftp|postgres(?:ql)?|mysql|redis|mongodb|amqp|ssh)://[A-Za-z0-9._~:@%/?#&=+-]+", re.IGNORECASE | re.ASCII)
CHANGE = re.compile(r"(?<=[a-z])[A-Z](?![a-z]{2})|(?<=[A-Z])[a-z](?![a-z])|(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]")
#: least share of changes among the neighbouring characters of a weak secret
LEAST_CHANGES = 0.2
BLANK_LINE = re.compile(r"\n[\x20\x09\r]*\n\s*")

KINDS = ["assign", "access", "hex", "secret", "identifier", "endpoint"]
STRONG = 3
SECRETS, IDENTIFIERS = (0, 2, 3), (1, 4)
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
FOUND = pa.schema([("doc_id", pa.int64()), ("spans", SPANS)])
SPANS_DDL = "array<struct<kind:string,start:long,end:long>>"


def looks_random(key: str) -> bool:
    """Whether letters and digits change as often as in a random key.

    Counted are the places inside the key's runs of letters and digits where a digit meets a
    letter, or a small letter a capital one that begins no word: 0.4 to 0.5 of all neighbours
    in random base64, base36 and hex, but few in words, paths, years and version numbers.
    """
    if not any(c.isdigit() for c in key) or not any(c.isalpha() for c in key):
        return False
    return len(CHANGE.findall(key)) >= LEAST_CHANGES * (len(key) - 1)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all strong spans and weak candidates, by start."""
    low = text.lower()
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    strong = sorted((a, b) for a, _, b in out)
    weak = [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)] if "://" in text else []
    if any(w in low for w in ("user", "login", "client", "account")):
        weak += [(m.start(), 4, m.end()) for m in IDENTIFIER.finditer(text)]
    addresses = [(a, b) for a, k, b in weak if k == 5]
    at = 0
    for m in KEY_LIKE.finditer(text):
        if not looks_random(m.group()):
            continue
        while at < len(addresses) and addresses[at][1] <= m.start():
            at += 1
        # in an address a key is a value or a password, not a part of the path
        if at < len(addresses) and addresses[at][0] <= m.start() and text[m.start() - 1] not in "=:":
            continue
        weak.append((m.start(), 3, m.end()))
    if weak and strong:
        starts = np.array([a for a, _ in strong])
        reach = np.maximum.accumulate(np.array([b for _, b in strong]))
        before = np.searchsorted(starts, [b for _, _, b in weak], side="left")
        weak = [w for w, n in zip(weak, before.tolist(), strict=True) if n == 0 or reach[n - 1] <= w[0]]
    return sorted(out + weak)


def scan(texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
    """Reported (start, kind number, end) of every text."""
    found = [candidates(t) if t else [] for t in texts]
    flat = [(i, a, k) for i, own in enumerate(found) for a, k, _ in own]
    if not any(k >= STRONG for _, _, k in flat):
        return found
    owner, start, kind = np.array(flat, np.int64).T
    # scopes of all texts are numbered on end
    scope, base = np.zeros(len(flat), np.int64), 0
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in np.unique(owner).tolist():
        rows = slice(first[i], first[i + 1])
        breaks = np.array([m.end() for m in BLANK_LINE.finditer(texts[i])], np.int64)
        scope[rows] = base + np.searchsorted(breaks, start[rows], side="right")
        base += len(breaks) + 1

    def has(kinds: tuple[int, ...]) -> np.ndarray:
        there = np.zeros(base, bool)
        there[scope[np.isin(kind, kinds)]] = True
        return there[scope]

    by_secret, by_identifier = has(SECRETS), has(IDENTIFIERS)
    keep = ((kind < STRONG) | ((kind == 3) & by_identifier) | ((kind == 4) & by_secret)
            | ((kind == 5) & by_identifier & by_secret)).tolist()
    return [[s for s, k in zip(own, keep[first[i]:first[i + 1]], strict=True) if k] for i, own in enumerate(found)]


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points, by start) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own] for own in scan(texts[a:b])]
                yield table(FOUND, doc_id=ids.slice(a, b - a), spans=spans)

    return ship(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, spans {SPANS_DDL}")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by ``[SECRET]``."""
    out, upto = [], 0
    for start, _, end in spans:
        if start >= upto:
            out += [text[upto:start], "[SECRET]"]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all reported spans of ``text`` replaced, other columns as they are
    (``n_chars``, where there is one, counted again for changed texts)."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            new: list[str | None] = []
            for a, b in text_slices(texts):
                new += [redacted(t, s) if s else t for t, s in zip(texts[a:b], scan(texts[a:b]), strict=True)]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in columns:
                n = batch.schema.get_field_index("n_chars")
                was = batch.column(n).to_pylist()
                arrays[n] = pa.array([w if x == t else len(x) for w, x, t in zip(was, new, texts, strict=True)], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return ship(docs).mapInArrow(run, docs.schema)
