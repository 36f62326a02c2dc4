"""Centring, alignment and slot profiles.

Centring cuts each sentence at a position (sentence form, narrow).  Slot
profiles line all centred sentences up by relative position and count the
values per ``(level, rel_pos)``; the reference's ``None`` padding of
shorter sentences is added arithmetically per slot instead of being
materialised, so the cost does not depend on the longest sentence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.functions.arrays import first_position
from wordlens.session import cut_lineage
from wordlens.sources.corpus import Corpus


def _cut(arr: Column, p: Column, direction: int) -> Column:
    """Suffix from ``p`` (direction > 0), prefix up to ``p`` (0), reversed prefix (< 0)."""
    empty = F.slice(arr, 1, 0)
    if direction > 0:
        cut = F.slice(arr, p + 1, F.greatest(F.size(arr), F.lit(1)))
        cut = F.when(p < F.size(arr), cut).otherwise(empty)
    else:
        cut = F.slice(arr, 1, p + 1)
        if direction < 0:
            cut = F.reverse(cut)
    return F.when(p.isNull(), empty).otherwise(cut)


def centre_at_positions(corpus: Corpus, positions: DataFrame, direction: int = 1,
                        levels: Sequence[int] = (0,), positions_col: str = "positions") -> DataFrame:
    """Centre every sentence at the first position listed for it.

    ``positions`` holds one row per sentence key with an array of positions
    (e.g. the output of W1).  A sentence without a row or with an empty
    array becomes empty; a key listed twice raises (the reference raises on
    a list of the wrong length).  Output (sentence form): keys, ``n_tokens``,
    ``l<level>`` arrays of the cut sentence.

    The positions are aggregated per key (one shuffle) and left-joined to the
    sentences on the full key; the join reuses that partitioning.
    """
    keys = list(corpus.keys)
    firsts = positions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.first(F.get(F.col(positions_col), 0), ignorenulls=True).alias("_p0"),
    ).select(*keys, F.when(F.col("_n") > 1, F.raise_error(F.lit("duplicate sentence key in positions")))
             .otherwise(F.col("_p0")).cast("int").alias("_p"))
    base = corpus.df.select(*keys, "n_tokens", *[corpus.level_array(lv).alias(f"_l{lv}") for lv in levels])
    joined = base.join(firsts, keys, "left")
    return joined.select(*keys, "n_tokens",
                         *[_cut(F.col(f"_l{lv}"), F.col("_p"), direction).alias(f"l{lv}") for lv in levels])


def centre_at_position(corpus: Corpus, position: int, direction: int = 1,
                       levels: Sequence[int] = (0,)) -> DataFrame:
    """W5 with the same position for every sentence (narrow, no join)."""
    p = F.lit(position)
    return corpus.df.select(*corpus.keys, "n_tokens",
                            *[_cut(corpus.level_array(lv), p, direction).alias(f"l{lv}") for lv in levels])


def centre_at_word(corpus: Corpus, word: str, direction: int = 1, level: int = 0,
                   levels: Sequence[int] = (0,)) -> DataFrame:
    """W5 at the first position of ``word`` in the same corpus (narrow, no join)."""
    staged = corpus.df.select(*corpus.keys, "n_tokens", "_tok", *corpus.tokenizer.needs,
                              first_position(corpus.level_array(level), word).alias("_p"))
    return staged.select(*corpus.keys, "n_tokens", *[
        _cut(corpus.tokenizer.level_array(F.col("_tok"), lv), F.col("_p"), direction).alias(f"l{lv}") for lv in levels])


def centre_word(corpus: Corpus, word: str, level: int = 0, levels: Sequence[int] | None = None) -> DataFrame:
    """Suffix of each sentence from the first occurrence of ``word``.

    ``level`` is where the word is searched (the reference always uses 0);
    ``levels`` are the levels returned (default: the search level).  Narrow.
    """
    return centre_at_word(corpus, word, 1, level, [level] if levels is None else levels)


def recentred_corpus(corpus: Corpus, word: str, level: int = 0) -> Corpus:
    """A new corpus of the suffixes from ``word`` (all levels kept).

    Sentences without the word stay, with length 0; positions restart at 0.
    """
    df = corpus.df.withColumn("_p", first_position(corpus.level_array(level), word))
    df = df.withColumn("_tok", _cut(F.col("_tok"), F.col("_p"), 1)).drop("_p")
    df = df.withColumn("n_tokens", F.size("_tok").cast("int"))
    return corpus.with_df(df)


def _slot_items(lv: int) -> Column:
    return F.transform(f"l{lv}", lambda x, i: F.struct(
        F.lit(lv).alias("level"), i.alias("rel_pos"), x.alias("value")))


def _slot_rows(centred: DataFrame, keys: Sequence[str], levels: Sequence[int],
               markers: bool = False) -> DataFrame:
    """One generator over all levels (one read of ``centred``).

    With ``markers`` every sentence also yields one row per level with
    ``rel_pos = -1``: counting them gives the number of sentences in the
    same aggregation.
    """
    items = [_slot_items(lv) for lv in levels]
    if markers:
        items.append(F.array(*[F.struct(F.lit(lv).alias("level"), F.lit(-1).alias("rel_pos"),
                                         F.lit(None).cast("string").alias("value")) for lv in levels]))
    return (centred.select(*keys, F.explode_outer(F.concat(*items)).alias("_s"))
            .where(F.col("_s").isNotNull())
            .select(F.col("_s.level").alias("level"), F.col("_s.rel_pos").cast("int").alias("rel_pos"),
                    *keys, F.col("_s.value").alias("value")))


def slot_values(centred: DataFrame, keys: Sequence[str], levels: Sequence[int]) -> DataFrame:
    """W8 (long form): ``level, rel_pos``, keys, ``value`` for every aligned token.

    Input: sentence-form arrays ``l<level>`` (e.g. from W6).  Missing
    slots are simply absent rows (the reference fills them with ``None``).
    """
    return _slot_rows(centred, keys, levels)


def element_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Value -> frequency (map-side partial aggregation)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def slot_frequency(centred: DataFrame, keys: Sequence[str], levels: Sequence[int]) -> DataFrame:
    """A10: per ``(level, rel_pos)`` the number of sentences per value.

    Includes the reference's ``None`` padding: each slot gets a NULL count of
    ``n_sentences - sentences reaching the slot`` (merged with genuine NULL
    values), so every slot sums to the number of sentences of ``centred``
    (all sentences, also those the word is missing from).  Slots run up to
    the longest aligned sentence.

    One pass: the slot rows and one marker row per sentence and level go
    through a single aggregation, checkpointed; slot totals and sentence
    counts are then read from that aggregated table and joined on
    ``level``.  Padding is never materialised.
    """
    # checkpointed: the three reads below would otherwise each get their own
    # pushed-down filter and recompute the aggregation from the corpus
    counts = cut_lineage(_slot_rows(centred, keys, levels, markers=True)
                         .groupBy("level", "rel_pos", "value").agg(F.count(F.lit(1)).alias("n")))
    n_sent = counts.where(F.col("rel_pos") == -1).select("level", F.col("n").alias("_ns"))
    real = counts.where(F.col("rel_pos") >= 0)
    totals = real.groupBy("level", "rel_pos").agg(F.sum("n").alias("_tot"))
    pads = (totals.join(F.broadcast(n_sent), "level")  # one row per level
            .select("level", "rel_pos", F.lit(None).cast("string").alias("value"),
                    (F.col("_ns") - F.col("_tot")).alias("n"))
            .where(F.col("n") > 0))
    return (real.unionByName(pads)
            .groupBy("level", "rel_pos", "value").agg(F.sum("n").cast("long").alias("n")))
