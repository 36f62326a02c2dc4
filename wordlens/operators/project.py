"""Projections, slices and value maps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.functions.arrays import map_values as _map_values
from wordlens.functions.arrays import sub_range, trim_pad
from wordlens.functions.tokenise import N_LEVELS, level_name
from wordlens.sources.corpus import Corpus


def level_values(corpus: Corpus, level: int = 0) -> DataFrame:
    """One level for every token, EOS removed: keys, ``pos``, ``value``."""
    return (corpus.level_tokens(level).where(~F.col("is_eos"))
            .select(*corpus.keys, "pos", "value"))


def wordlist(corpus: Corpus) -> DataFrame:
    """P1 on level 0."""
    return level_values(corpus, 0)


def level_window(corpus: Corpus, start: int, stop: int) -> DataFrame:
    """Levels ``[start, stop)`` of every token, EOS removed; clamps to 30 levels."""
    stop = min(stop, N_LEVELS)
    start = max(start, 0)
    levels = list(range(start, stop))
    toks = corpus.tokens(levels).where(~F.col("is_eos"))
    return toks.select(*corpus.keys, "pos", *[F.col("info")[level_name(lv)].alias(level_name(lv)) for lv in levels])


def level_per_sentence(corpus: Corpus, level: int = 0) -> DataFrame:
    """Per sentence the values of one level in token order, EOS kept."""
    return corpus.level_form(level, "values")


def show_level(corpus: Corpus, level: int = 0, sep: str = " ") -> DataFrame:
    """P5: P4 as one joined line per sentence, ordered by key."""
    return (corpus.level_form(level, "values")
            .select(*corpus.keys, F.array_join("values", sep).alias("line"))
            .orderBy(*corpus.keys))


def sub_sentence(df: DataFrame, col: str, start: int, stop: int, out: str | None = None) -> DataFrame:
    """P6 (sentence form): ``col[start:stop]`` of every row; clamps, short rows give fewer."""
    return df.withColumn(out or col, sub_range(col, start, stop))


def sub_sentence_long(tokens: DataFrame, start: int, stop: int, pos_col: str = "pos") -> DataFrame:
    """P6 (long form): tokens with ``start <= pos < stop``."""
    return tokens.where((F.col(pos_col) >= start) & (F.col(pos_col) < stop))


def trim_sentence_to_length(df: DataFrame, col: str, n: int | Column, out: str | None = None) -> DataFrame:
    """Cut to ``n`` or pad by repeating the last element; empty stays empty."""
    return df.withColumn(out or col, trim_pad(col, n))


def map_values(df: DataFrame, cols: Sequence[str], func: Callable[[Column], Column],
               depth: int = 0) -> DataFrame:
    """Apply a Column function to every value of the given columns.

    ``depth`` is the array nesting of the columns (0 scalar, 1 array, ...).
    """
    out = df
    for c in cols:
        out = out.withColumn(c, _map_values(F.col(c), func, depth))
    return out
