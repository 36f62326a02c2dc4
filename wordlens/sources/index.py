"""Positional index: term -> sentences and positions.

One row per term and sentence (``term``, sentence key, ``n_tokens``, ``positions``).  Rows are
dealt into slots by a hash of the term and a salt from the sentence key, so a hot term (the
end marker is in every sentence) is cut into ``SALTS`` blocks and is no one task's work, in
writing or reading.  A slot is a bucket of the table, sorted by term and key and written with
small row groups.  A lookup names the slots of its terms: the other buckets are not opened,
and in those the row groups whose statistics rule the terms out are not read.  Building is
one narrow pass and one shuffle of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.functions.arrays import percent_positions, with_term_profile
from wordlens.operators import keywords
from wordlens.sources.corpus import Corpus
from wordlens.sources.store import bucketed, ddl, open_bucketed

ROW_GROUP_BYTES = 1 << 20
#: blocks that the rows of a term are cut into
SALTS = 8
#: slots for each split that the corpus is read in, so that the task that sorts a slot stays as
#: small however large the corpus is
SLOTS_PER_SPLIT = 16
#: longest list of words that is looked up by a literal list; longer ones are joined
MOST_LITERALS = 1000


def term_positions(corpus: Corpus, level: int = 0) -> DataFrame:
    """keys, ``n_tokens``, ``term``, ``positions``: one row per sentence and term. Narrow."""
    base = corpus.df.select(*corpus.keys, "n_tokens", corpus.level_array(level).alias("_lv"))
    return (with_term_profile(base, "_lv", positions=True)
            .select(*corpus.keys, "n_tokens", F.explode_outer("_prof").alias("_p")).where(F.col("_p").isNotNull())
            .select(*corpus.keys, "n_tokens", F.col("_p.term").alias("term"), F.col("_p.positions").alias("positions"))
            .where(F.col("term").isNotNull()))


@dataclass(frozen=True)
class PositionalIndex:
    df: DataFrame
    keys: tuple[str, ...]
    slots: int

    def _of(self, words: Sequence[str]) -> DataFrame:
        """The rows of some words."""
        slots = self.df.sparkSession.createDataFrame([(w, s) for w in words for s in range(SALTS)], "term string, salt int").select(
            _slot(F.col("term"), F.col("salt"), self.slots).alias("s")).distinct().collect()   # at most SALTS for each word
        return self.df.where(F.col("_slot").isin(*[r["s"] for r in slots]) & F.col("term").isin(*words))

    def hits(self, words: Sequence[str] | DataFrame, in_percent: bool = False) -> DataFrame:
        """W3/W4 for the sentences that have the word: ``word_no, term``, keys, ``n_tokens``,
        ``positions``; ``words`` is a list or a table of ``word_no, term``."""
        if not isinstance(words, DataFrame):
            found, n_words = self._of(words) if len(words) <= MOST_LITERALS else self.df, len(words)
            words = self.df.sparkSession.createDataFrame(list(enumerate(words)), "word_no int, term string")
        else:
            found, n_words = self.df, words.count()
        # the rows of a few words are not dealt by them: all of a hot word would be one task's
        out = keywords.salted_join(found, words.select("word_no", "term"), "term", n_words, self.keys)
        positions = percent_positions("positions", "n_tokens") if in_percent else F.col("positions")
        return out.select("word_no", "term", *self.keys, "n_tokens", positions.alias("positions"))

    def rows(self, word: str) -> DataFrame:
        return self._of([word])

    def positions(self, sentences: DataFrame, word: str) -> DataFrame:
        """Keys, ``n_tokens``, ``positions`` of every row of ``sentences`` (``[]`` if none)."""
        keys = list(self.keys)
        hits = self.rows(word).select(*keys, "positions")
        return sentences.join(hits, keys, "left").select(
            *keys, "n_tokens", F.coalesce("positions", F.array().cast("array<int>")).alias("positions"))

    def occurrence(self, sentences: DataFrame, word: str) -> DataFrame:
        """Occurrences of ``word`` in every sentence, zeros kept."""
        p = self.positions(sentences, word)
        return p.select(*self.keys, F.size("positions").cast("long").alias("tf"))

    def word_stats(self, word: str) -> DataFrame:
        """A7 (with A11): statistics of one word; an unknown word gives no row."""
        n = F.size("positions")
        total = self.rows(word).agg(F.count("*").alias("binary"), F.sum(n).alias("count"), F.avg(F.get("positions", F.lit(0))).alias("pos_index"))
        return total.where(F.col("binary") > 0).select(F.lit(word).alias("term"), "binary", "count", (F.col("binary") / F.col("count")).alias("quote"), "pos_index")

    def drilldown(self, sentences: DataFrame, report: DataFrame, rank: int) -> DataFrame:
        """W1 of the word that the report has at ``rank``."""
        row = report.where(F.col("rank") == rank).select("term").first()   # the picked line
        out = self.positions(sentences, row["term"]) if row else self.positions(sentences, "").limit(0)
        return out.select(F.lit(rank).alias("rank"), F.lit(row["term"] if row else None).cast("string").alias("term"), *self.keys, "positions")


def _slot(term: Column, salt: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(term, salt), F.lit(slots)).cast("int")


def build_index(corpus: Corpus, path: str, level: int = 0, slots: int | None = None,
                row_group_bytes: int = ROW_GROUP_BYTES) -> PositionalIndex:
    """Write the index of one level and open it; ``slots`` unset: ``SLOTS_PER_SPLIT`` for each
    split of the corpus, the session's shuffle partitions at least."""
    slots = slots or max(int(corpus.spark.conf.get("spark.sql.shuffle.partitions")), SLOTS_PER_SPLIT * corpus.df.rdd.getNumPartitions())
    salt = F.pmod(F.xxhash64(*corpus.keys), F.lit(SALTS)).cast("int")
    rows = term_positions(corpus, level).select(_slot(F.col("term"), salt, slots).alias("_slot"), "term", *corpus.keys, "n_tokens", "positions")
    df = bucketed(rows.repartition(slots, "_slot"), f"{path}/rows", ["_slot"], slots, ["term", *corpus.keys], **{"parquet.block.size": row_group_bytes})
    info = corpus.spark.range(1).select(F.lit(slots).alias("slots"), F.array(*map(F.lit, corpus.keys)).alias("keys"), F.lit(ddl(rows)).alias("columns"))
    info.write.parquet(f"{path}/info")
    return PositionalIndex(df, corpus.keys, slots)


def open_index(spark: SparkSession, path: str) -> PositionalIndex:
    info = spark.read.parquet(f"{path}/info").first()   # one row
    df = open_bucketed(spark, f"{path}/rows", info["columns"], ["_slot"], info["slots"], ["term", *info["keys"]])
    return PositionalIndex(df, tuple(info["keys"]), info["slots"])
