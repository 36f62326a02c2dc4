"""Word positions inside sentences.

Sentence form throughout: one row per sentence, positions computed with
array expressions over the sentence's level array.  Narrow (no shuffle),
and sentences without a hit keep an empty array, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.functions.arrays import percent_positions, positions_of
from wordlens.operators.keywords import salted_join
from wordlens.sources.corpus import Corpus
from wordlens.sources.index import term_positions


def positions_abs(corpus: Corpus, word: str, level: int = 0) -> DataFrame:
    """Keys, ``n_tokens``, ``positions`` (0-based, ``[]`` if none)."""
    t = corpus.level_form(level, "_t")
    return t.select(*corpus.keys, "n_tokens", positions_of("_t", word).alias("positions"))


def positions_pct(corpus: Corpus, word: str, level: int = 0) -> DataFrame:
    """Like W1 in percent of the sentence (``pos*100/(n-1)``, 0 if n <= 1)."""
    p = positions_abs(corpus, word, level)
    return p.select(*corpus.keys, "n_tokens",
                    percent_positions("positions", "n_tokens").alias("positions"))


def _words_literal(words: Sequence[str]):
    return F.array(*[F.lit(w) for w in words])


def wordlist_abs(corpus: Corpus, words: Sequence[str], level: int = 0, aligned: bool = True) -> DataFrame:
    """W1 for each word of a list: ``word_no, term``, keys, ``n_tokens``, ``positions``.

    The word list is a literal array carried in the expression (it is a
    driver-side Python list, so its size is known); each sentence row
    explodes into one row per word.  No join, no shuffle.  ``aligned=False``
    leaves out the words a sentence does not have.
    """
    if not words:
        raise ValueError("empty word list")
    t = corpus.level_form(level, "_t")
    per_word = F.transform(_words_literal(words), lambda w: F.struct(
        w.alias("term"),
        F.filter(F.transform("_t", lambda x, i: F.when(x == w, i).otherwise(-1)),
                 lambda q: q >= 0).alias("positions")))
    if not aligned:
        per_word = F.filter(F.transform(per_word, lambda e, i: F.struct(i.alias("word_no"), e.alias("w"))),
                            lambda e: F.size(e["w"]["positions"]) > 0)
        return t.select(*corpus.keys, "n_tokens", F.explode_outer(per_word).alias("_w")).where(F.col("_w").isNotNull()).select(
            F.col("_w.word_no").cast("int").alias("word_no"), F.col("_w.w.term").alias("term"),
            *corpus.keys, "n_tokens", F.col("_w.w.positions").alias("positions"))
    return (t.select(*corpus.keys, "n_tokens", F.posexplode_outer(per_word).alias("word_no", "_w"))
            .where(F.col("word_no").isNotNull())
            .select(F.col("word_no").cast("int").alias("word_no"), F.col("_w.term").alias("term"),
                    *corpus.keys, "n_tokens", F.col("_w.positions").alias("positions")))


def wordlist_pct(corpus: Corpus, words: Sequence[str], level: int = 0, aligned: bool = True) -> DataFrame:
    """W2 for each word of a list."""
    p = wordlist_abs(corpus, words, level, aligned)
    return p.withColumn("positions", percent_positions("positions", "n_tokens"))


def wordlist_table(corpus: Corpus, words: DataFrame, level: int = 0, in_percent: bool = False) -> DataFrame:
    """W3/W4 for a table of words (``word_no, term``, each term once) of any length.

    ``word_no, term``, keys, ``n_tokens``, ``positions`` for the words that a sentence has.
    Every sentence is sorted into (term, positions) rows once, whatever the number of words,
    and these rows meet the words by their term: a broadcast hash join for a table of at most
    ``SMALL_TABLE_ROWS`` rows, a salted one beyond (:func:`keywords.salted_join`).
    """
    rows = salted_join(term_positions(corpus, level), words.select("word_no", "term"), "term", words.count(), corpus.keys)
    positions = percent_positions("positions", "n_tokens") if in_percent else F.col("positions")
    return rows.select("word_no", "term", *corpus.keys, "n_tokens", positions.alias("positions"))


def show_positions(corpus: Corpus, word: str, level: int = 0) -> DataFrame:
    """W1 per sentence, ordered by key."""
    return positions_abs(corpus, word, level).orderBy(*corpus.keys)


def explode_positions(df: DataFrame, keys: Sequence[str], col: str = "positions") -> DataFrame:
    """Flat ``(…keys, hit_no, position)`` rows of a positions column."""
    return (df.select(*keys, F.posexplode_outer(col).alias("hit_no", "position"))
            .where(F.col("hit_no").isNotNull()))
