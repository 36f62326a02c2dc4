"""Native tokeniser and sentence splitter expressions.

Fixed values (the shared contract with the SQL oracle):

* token pattern: a run of letters, a run of digits, or one other
  non-space character -- ``\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]``
* end-of-sentence marker appended to every sentence: ``EOS``
* token classes of level 1: ``WORD`` (starts with a letter), ``NUM``
  (starts with a digit), ``PUNCT`` (anything else), ``EOS`` (the marker)
* number of analyser levels per token: 30 (``f00`` .. ``f29``)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"
EOS = "EOS"
N_LEVELS = 30
LEVEL_NAMES = [f"f{i:02d}" for i in range(N_LEVELS)]
WORD, NUM, PUNCT = "WORD", "NUM", "PUNCT"

# Python's str.split() splits on Unicode whitespace (U+3000 included);
# Java needs (?U) for \s to do the same.
UNICODE_WHITESPACE = r"(?U)\s+"


def regex_tokens(text: Column) -> Column:
    """``array<string>`` of surfaces in ``text`` (no EOS)."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)


def with_eos(tokens: Column) -> Column:
    return F.concat(tokens, F.array(F.lit(EOS)))


def token_class(surface: Column) -> Column:
    """Level-1 class of a surface produced by :data:`TOKEN_PATTERN`.

    ASCII is told by comparing bytes; only other first characters need the regular expressions.
    """
    def first(low: str, beyond: str) -> Column:
        return (surface >= low) & (surface < beyond)

    return (
        F.when(first("a", "{") | first("A", "["), F.lit(WORD))
        .when(first("0", ":"), F.lit(NUM))
        .when(surface < "\x80", F.lit(PUNCT))
        .when(surface.rlike(r"^\p{L}"), F.lit(WORD))
        .when(surface.rlike(r"^\p{N}"), F.lit(NUM))
        .otherwise(F.lit(PUNCT))
    )


def whitespace_units(text: Column) -> Column:
    """Split on runs of Unicode whitespace and drop empty pieces."""
    return F.filter(F.split(text, UNICODE_WHITESPACE, -1), lambda s: s != "")


def level_name(level: int) -> str:
    if not 0 <= level < N_LEVELS:
        raise ValueError(f"level must be in 0..{N_LEVELS - 1}, got {level}")
    return LEVEL_NAMES[level]
