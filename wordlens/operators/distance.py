"""Distances between the words of a list inside a sentence.

Per sentence, with ``P_i`` the positions of word ``i`` (``[1000]`` when
absent) and ``C`` the product of the lengths of the non-empty lists (1
when all are absent), the reference cycles every list to length ``C`` and
defines ``D[i][j][c] = P_i[0] - P_j[c mod len(P_j)]``.

The expanded form repeats each distinct value ``C / len(P_j)`` times.  The
rows here are the exact compact form: one row per ``(i, j, k)`` with ``k``
indexing ``P_j``, its length ``n_j`` and the lengths ``sizes`` of all lists.
``C`` is the product of ``sizes`` and may exceed any number type, so it is
never computed here; the output does not grow with it.  Narrow: array
expressions per sentence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.sources.corpus import Corpus

# Fixed value: the reference's distance sentinel for a word absent from the sentence.
ABSENT = 1000


def distance(corpus: Corpus, words: Sequence[str], level: int = 0,
             expand: bool = False) -> DataFrame:
    """Keys, ``i, term_i, j, term_j, k, distance, n_j, sizes`` (compact).

    With ``expand=True`` each compact row is repeated and ``k`` becomes the
    combination index ``c`` (0..C-1, long), i.e. the reference's cube
    ``[i][j][c]``; a sentence whose ``C`` exceeds a long raises.
    """
    if not words:
        raise ValueError("empty word list")
    wl = F.array(*[F.lit(w) for w in words])
    t = corpus.level_form(level, "_t")
    staged = t.select(*corpus.keys, F.transform(wl, lambda w: F.filter(
        F.transform("_t", lambda x, i: F.when(x == w, i).otherwise(-1)), lambda q: q >= 0)).alias("_P"))
    staged = staged.select(
        *corpus.keys,
        # an absent word has one entry, the sentinel: its length 1 leaves the product as it is
        F.transform("_P", lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.lit(ABSENT)))).alias("_F"))
    # outer generators + null filters (no inferred filters re-running the arrays)
    i_rows = (staged.select(*corpus.keys, "_F", F.transform("_F", F.size).alias("sizes"),
                            F.posexplode_outer("_F").alias("i", "_Fi"))
              .where(F.col("i").isNotNull()))
    ij_rows = (i_rows.select(*corpus.keys, "sizes", "i", F.element_at("_Fi", 1).alias("_first"),
                             F.posexplode_outer("_F").alias("j", "_Fj"))
               .where(F.col("j").isNotNull()))
    out = ij_rows.select(
        *corpus.keys,
        F.col("i").cast("int").alias("i"), wl[F.col("i")].alias("term_i"),
        F.col("j").cast("int").alias("j"), wl[F.col("j")].alias("term_j"),
        F.col("_first"), F.size("_Fj").alias("n_j"), "sizes",
        F.posexplode_outer("_Fj").alias("k", "_pj"),
    ).where(F.col("k").isNotNull()).select(
        *corpus.keys, "i", "term_i", "j", "term_j", F.col("k").cast("int").alias("k"),
        (F.col("_first") - F.col("_pj")).cast("int").alias("distance"), "n_j", "sizes",
    )
    if not expand:
        return out
    product = F.aggregate("sizes", F.lit(1).cast("long"), lambda acc, n: F.try_multiply(acc, n.cast("long")))
    combinations = F.when(product.isNull(), F.raise_error(F.lit("too many combinations to expand"))).otherwise(product)
    # the cycled list holds P_j[k] at c = k, k + n_j, k + 2 n_j, ... below C
    rep = out.withColumn("_C", combinations.cast("long")).withColumn("c", F.explode(F.sequence(
        F.col("k").cast("long"), F.col("_C") - F.col("n_j") + F.col("k"), F.col("n_j").cast("long"))))
    return rep.select(*corpus.keys, "i", "term_i", "j", "term_j", "c", "distance")


def distance_cells(corpus: Corpus, words: Sequence[str], first: int, last: int, level: int = 0) -> DataFrame:
    """The cube's cells with combination index ``first <= c < last``: keys, ``i, term_i,
    j, term_j, c, distance`` and ``combinations`` (C as text).

    A cell is read by its index, ``P_i[0] - P_j[c mod n_j]``: nothing is expanded, and the
    range may lie anywhere below C, which may exceed any number type.  A sentence with
    fewer combinations gives the cells that it has.
    """
    wl = F.array(*[F.lit(w) for w in words])
    t = corpus.level_form(level, "_t")
    # one look at every token; the words are told apart among the few that are of the list.  Each
    # step stands inside a generator, so that no later filter is pushed below it and makes it anew
    hits = F.array_compact(F.transform("_t", lambda x, i: F.when(x.isin(*words), F.struct(x.alias("w"), i.alias("p")))))
    lists = t.select(*corpus.keys, F.inline_outer(F.array(F.struct(hits.alias("_h")))))
    own = F.transform(wl, lambda w: F.filter("_h", lambda e: e["w"] == w)["p"])
    lists = lists.select(*corpus.keys, F.inline_outer(F.array(F.struct(
        F.transform(own, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.lit(ABSENT)))).alias("_F")))))
    # min(C, last): the product stops growing where the range ends
    upto = F.aggregate("_F", F.lit(1).cast("long"), lambda acc, p: F.least(acc * F.size(p), F.lit(last).cast("long")))
    whole = F.aggregate("_F", F.lit(1).cast("decimal(38,0)"), lambda acc, p: F.try_multiply(acc, F.size(p).cast("decimal(10,0)")).cast("decimal(38,0)"))
    lists = lists.select(*corpus.keys, "_F", upto.alias("_upto"), whole.cast("string").alias("combinations"))
    # the asked places of every list are read inside the sentence, so that no row carries the lists
    span = F.when(F.col("_upto") > first, F.sequence(F.lit(first).cast("long"), F.col("_upto") - 1))
    lists = lists.select(*corpus.keys, "combinations", F.transform("_F", lambda p: F.get(p, F.lit(0))).alias("_firsts"),
                         F.transform("_F", lambda p: F.transform(span, lambda c: F.get(p, (c % F.size(p)).cast("int")))).alias("_ats"))
    cells = lists.select(*corpus.keys, "combinations", "_firsts", F.posexplode_outer("_ats").alias("j", "_at"))
    pairs = cells.select(*corpus.keys, "combinations", "_firsts", "j", F.posexplode_outer("_at").alias("_k", "_at")).where(F.col("_k").isNotNull())
    rows = pairs.select(*corpus.keys, "combinations", "j", "_at", (F.col("_k").cast("long") + F.lit(first).cast("long")).alias("c"),
                        F.posexplode_outer("_firsts").alias("i", "_first"))
    return rows.select(*corpus.keys, F.col("i").cast("int").alias("i"), wl[F.col("i")].alias("term_i"), F.col("j").cast("int").alias("j"),
                       wl[F.col("j")].alias("term_j"), "c", (F.col("_first") - F.col("_at")).cast("int").alias("distance"), "combinations")
