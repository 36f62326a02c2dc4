"""Reshaping.

The reference builds dense NumPy cubes (sentence x token x field).  Here
the dense shapes are produced per row (R1, R3, R4: narrow array
expressions) or, where the reference moves the sentence axis innermost
(R2), as per-slot counts in long form with the padding computed
arithmetically, so nothing of size ``n_sentences x longest`` is ever
materialised unless a caller explicitly asks for the padded arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlens.functions.arrays import ragged_transpose as _ragged_transpose
from wordlens.functions.arrays import trim_pad
from wordlens.session import cut_lineage
from wordlens.sources.corpus import Corpus


def padded_sentences(corpus: Corpus, level: int = 0, width: int | None = None) -> DataFrame:
    """Every sentence padded to the longest one, its last token repeated.

    Output: keys, ``n_tokens``, ``values``, ``pad_value``, ``pad_count``: the
    dense row is ``values`` followed by ``pad_count`` times ``pad_value``, so
    no row grows with the longest sentence.  With an explicit ``width`` the
    rows are cut or padded to it: keys, ``n_tokens``, ``padded``.
    """
    values = corpus.level_array(level)
    if width is not None:
        return corpus.df.select(*corpus.keys, "n_tokens", trim_pad(values, width).alias("padded"))
    longest = corpus.longest()
    return corpus.df.select(*corpus.keys, "n_tokens", values.alias("values"),
                            F.get(values, F.size(values) - 1).alias("pad_value"),
                            (longest - F.col("n_tokens")).cast("int").alias("pad_count"))


def axes_moved_counts(corpus: Corpus, levels: Sequence[int] = (0,)) -> DataFrame:
    """R2 (+A9 on it): per ``(pos, level)`` the values over all sentences, as counts.

    The reference pads every sentence to the longest one by repeating its
    last token and then reads, for each position and field, the values of
    all sentences.  Counts per ``(pos, level, value)``: the real tokens,
    plus for each sentence its last value once for every position past its
    end.

    One pass: token rows and one ``(length, last value)`` marker per
    sentence and level come out of a single generator into one aggregation.
    The padding is then derived from the marker histogram with a running
    sum -- one row per slot and value, bounded by the longest sentence and
    the distinct last values, not by the corpus.
    """
    def tokens(lv: int) -> Column:
        return F.transform(f"_a{lv}", lambda x, i: F.struct(
            F.lit(False).alias("marker"), F.lit(lv).alias("level"), i.alias("pos"), x.alias("value")))

    def marker(lv: int) -> Column:
        return F.when(F.col("n_tokens") > 0, F.array(F.struct(
            F.lit(True).alias("marker"), F.lit(lv).alias("level"), F.col("n_tokens").alias("pos"),
            F.element_at(f"_a{lv}", -1).alias("value")))).otherwise(F.array())

    base = corpus.df.select("n_tokens", *[corpus.level_array(lv).alias(f"_a{lv}") for lv in levels])
    items = F.concat(*[tokens(lv) for lv in levels], *[marker(lv) for lv in levels])
    # checkpointed: both reads below would otherwise recompute it from the corpus
    counts = cut_lineage(
        base.select(F.explode_outer(items).alias("_r")).where(F.col("_r").isNotNull())
        .select("_r.marker", "_r.level", F.col("_r.pos").cast("int").alias("pos"), "_r.value")
        .groupBy("marker", "level", "pos", "value").agg(F.count(F.lit(1)).alias("n")))
    real = counts.where(~F.col("marker")).drop("marker")
    hist = counts.where(F.col("marker")).select("level", F.col("pos").alias("len"), "value", F.col("n").alias("c"))
    # the histogram has one row per (level, length, last value): bounded by the longest sentence
    w = Window.partitionBy("level", "value").orderBy("len")
    longest = hist.groupBy("level").agg(F.max("len").alias("_longest"))
    steps = hist.select(
        "level", "value", "len",
        F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cum"),
        F.lead("len").over(w).alias("_next")).join(F.broadcast(longest), "level")  # one row per level
    pads = (steps.select("level", "value", "len", "cum", F.coalesce("_next", "_longest").alias("next_len"))
            .where(F.col("len") < F.col("next_len"))
            .select("level", "value", "cum", F.explode(F.sequence("len", F.col("next_len") - 1)).alias("pos"))
            .select("level", "pos", "value", F.col("cum").alias("n")))
    both = real.unionByName(pads).groupBy("pos", "level", "value").agg(F.sum("n").cast("long").alias("n"))
    return both.select(F.col("pos").cast("int").alias("pos"), "level", "value", "n")


def axes_moved(corpus: Corpus, levels: Sequence[int] = (0,)) -> DataFrame:
    """R2 (long form): ``pos, level``, keys, ``value`` with last-token padding materialised.

    Only for bounded corpora (size ``n_sentences x longest x levels``);
    prefer :func:`axes_moved_counts` at scale.
    """
    longest = corpus.df.agg(F.max("n_tokens")).scalar()
    padded = F.array(*[F.struct(F.lit(lv).alias("level"), trim_pad(corpus.level_array(lv), longest).alias("_a"))
                       for lv in levels])
    return (corpus.df.select(*corpus.keys, F.inline_outer(padded))
            .select("level", *corpus.keys, F.posexplode_outer("_a").alias("pos", "value"))
            .where(F.col("pos").isNotNull())
            .select(F.col("pos").cast("int").alias("pos"), "level", *corpus.keys, "value"))


def axes_moved_intervals(corpus: Corpus, levels: Sequence[int] = (0,)) -> DataFrame:
    """R2 as intervals: ``level``, keys, ``start``, ``stop``, ``value``: the sentence has
    ``value`` at every position of ``[start, stop)``.

    A row stands for a run of equal values; the last one reaches to the longest sentence, so
    padding costs no rows.  The sentences are tokenised once and written as narrow arrays:
    the width is read from their lengths.  Empty sentences have no rows.
    """
    arrays = cut_lineage(corpus.df.select(*corpus.keys, "n_tokens", *[corpus.level_array(lv).alias(f"_a{lv}") for lv in levels]))
    width = arrays.agg(F.max("n_tokens")).scalar()

    def starts(lv: int) -> Column:
        a = F.col(f"_a{lv}")
        places = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: (i == 0) | ~F.get(a, i).eqNullSafe(F.get(a, i - 1)))

    cut = arrays.select(*corpus.keys, F.inline_outer(F.array(*[
        F.struct(F.lit(lv).alias("level"), F.col(f"_a{lv}").alias("_a"), starts(lv).alias("_s")) for lv in levels])))
    runs = F.transform("_s", lambda s, k: F.struct(s.alias("start"), F.get(F.col("_s"), k + 1).alias("stop"), F.get(F.col("_a"), s).alias("value")))
    rows = cut.select("level", *corpus.keys, F.explode_outer(runs).alias("_r")).where(F.col("_r").isNotNull())
    return rows.select("level", *corpus.keys, "_r.start", F.coalesce("_r.stop", width.cast("int")).alias("stop"), "_r.value")


def slot(intervals: DataFrame, pos: int) -> DataFrame:
    """R2: the values of all sentences at one position, from :func:`axes_moved_intervals`."""
    return intervals.where((F.col("start") <= pos) & (F.col("stop") > pos)).drop("start", "stop")


def interval_counts(intervals: DataFrame) -> DataFrame:
    """R2 with A9: ``level``, ``start``, ``stop``, ``value``, ``n``: how many sentences have
    ``value`` at each position of ``[start, stop)``; ranges without it are left out.

    Equal intervals are counted first, in the tasks that read them; each of them, not every
    sentence, adds its count at its start and takes it away at its stop.  These steps are
    exchanged once, by value: their sums per place and the running sum over the places of one
    value (at most the longest sentence) follow where they lie.
    """
    equal = intervals.groupBy("level", "value", "start", "stop").agg(F.count(F.lit(1)).alias("_n"))
    steps = equal.select("level", "value", F.inline(F.array(
        F.struct(F.col("start").alias("start"), F.col("_n").alias("_d")), F.struct(F.col("stop").alias("start"), (-F.col("_n")).alias("_d")))))
    sums = (steps.repartition("level", "value").groupBy("level", "value", "start").agg(F.sum("_d").alias("_d"))
            .where(F.col("_d") != 0))
    along = Window.partitionBy("level", "value").orderBy("start")
    return (sums.select("level", "value", "start", F.lead("start").over(along).alias("stop"),
                        F.sum("_d").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"))
            .where(F.col("n") > 0).select("level", "start", "stop", "value", "n"))


def ragged_transpose(df: DataFrame, col: str, place_holder: Column | None = None,
                     out: str | None = None) -> DataFrame:
    """Transpose a ragged ``array<array<T>>`` column row by row."""
    return df.withColumn(out or col, _ragged_transpose(F.col(col), place_holder))


def ragged_transpose_long(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """R3 (long form): keys, ``col``, ``row``, ``value`` for every present cell.

    Row ``r`` of the transpose holds the cells with ``col = r``; holes of
    short rows are absent, so nothing of size widest x rows is built.
    """
    rows = (df.select(*keys, F.posexplode_outer(col).alias("row", "_cells")).where(F.col("row").isNotNull()))
    return (rows.select(*keys, "row", F.posexplode_outer("_cells").alias("col", "value"))
            .where(F.col("col").isNotNull())
            .select(*keys, F.col("col").cast("int").alias("col"), F.col("row").cast("int").alias("row"), "value"))


def rotated_sentence(corpus: Corpus, levels: Sequence[int] = (0, 1)) -> DataFrame:
    """Each sentence turned 90 degrees clockwise: per level the values in reverse order.

    Output (sentence form): keys, ``level``, ``values`` (last token first).
    """
    turned = F.array(*[F.struct(F.lit(lv).alias("level"), F.reverse(corpus.level_array(lv)).alias("values"))
                       for lv in levels])
    return corpus.df.select(*corpus.keys, F.inline_outer(turned))
