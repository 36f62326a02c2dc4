"""A corpus written once and opened many times (S5, P1, P4 on storage).

Layout of a store, all Parquet:

``tokens/``   the sentence form: keys, ``n_tokens``, ``_tok array<struct<f00, f01, ..., is_eos>>``,
              bucketed and sorted by the full sentence key.  Every level is a column of its own
              in the file, so a query reads only the levels it names.
``shape/``    one row: ``n_sentences``, ``max_x``, ``n_tokens`` and what is needed to open the
              store (``keys``, ``levels``, ``buckets``, ``columns``).
``stats_NN/`` keyword statistics of level NN, one row per term (optional).

What is dealt to the buckets and sorted there is the sentences' text, where the corpus has it
(``Corpus.raw``): they are tokenised on the way into the files, so that no token is shuffled.

Tables that are bucketed alike meet without an exchange: ``store_table`` writes any table of
sentence keys (positions for W5, say) into the same buckets.  The full key decides the
bucket, so that the sentences of one huge document lie in many of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wordlens.functions.tokenise import level_name
from wordlens.session import shuffles_dropped
from wordlens.sources.corpus import Corpus, read_raw
from wordlens.sources.tokenizers import AnnotatedTokenizer


#: a bucket's tokens are numbers of its words: a file has room for the words of its bucket
TOKENS_OPTIONS = {"compression": "zstd", "parquet.dictionary.page.size": str(8 << 20)}


@dataclass(frozen=True)
class StoredCorpus(Corpus):
    """A corpus on storage: its shape is known and its statistics may be."""

    path: str = ""
    info: Row | None = None
    stat_levels: tuple[int, ...] = field(default=())

    def shape(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/shape").select("n_sentences", "max_x", "n_tokens")

    def n_sentences(self) -> Column:
        return F.lit(self.info["n_sentences"])

    def longest(self) -> Column:
        return F.lit(self.info["max_x"])

    def statistics(self, level: int) -> DataFrame | None:
        if level not in self.stat_levels:
            return None
        return self.spark.read.parquet(f"{self.path}/stats_{level:02d}")

    def with_df(self, df: DataFrame) -> Corpus:
        return Corpus(df, self.keys, self.tokenizer)   # another corpus: nothing of it is known

    def level_array(self, level: int = 0) -> Column:
        if level not in self.info["levels"]:
            raise ValueError(f"level {level} is not stored")
        return super().level_array(level)


def bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[str] | None = None, **options) -> DataFrame:
    """Write ``df``, which is dealt by ``keys``, in ``buckets`` buckets by them and open it."""
    name = f"wordlens_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, *keys).sortBy(*(order or keys)).options(**options)
     .option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


@contextmanager
def rows_in_place(spark: SparkSession) -> Iterator[None]:
    """Bucketed tables written inside are not sorted by the writer: a task keeps a file open
    (one more bucket would make it sort), rows stay in the order they have."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def open_bucketed(spark: SparkSession, path: str, columns: str, keys: Sequence[str], buckets: int, order: Sequence[str] | None = None) -> DataFrame:
    """A bucketed table written by any session; ``columns`` is its schema as DDL."""
    name = f"wordlens_{uuid.uuid4().hex}"
    by, sort = (", ".join(f"`{k}`" for k in names) for names in (keys, order or keys))
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY ({by}) SORTED BY ({sort}) INTO {buckets} BUCKETS")
    return spark.table(name)


def store_corpus(corpus: Corpus, path: str, levels: Sequence[int] = (0, 1), buckets: int | None = None) -> StoredCorpus:
    """Write ``corpus`` and open it.

    ``buckets`` should give files of some 100 MB; unset, the session's shuffle partitions.
    """
    spark = corpus.spark
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = corpus.tokenizer
    # the levels are made sentence by sentence and laid side by side, no token is built alone
    tok = F.col("_tok")
    fields = [*[read.level_array(tok, lv).alias(level_name(lv)) for lv in levels], read.eos_array(tok).alias("is_eos")]

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(buckets, *corpus.keys).sortWithinPartitions(*corpus.keys)

    # the text travels, or what the tokeniser made; the levels are made of it where they are written
    if corpus.raw is not None:
        rows = read_raw(dealt(corpus.raw), corpus.keys, read)
    else:
        rows = dealt(corpus.df.select(*corpus.keys, "n_tokens", "_tok", *read.needs))
    rows = rows.select(*corpus.keys, "n_tokens", F.arrays_zip(*fields).alias("_tok"))
    columns = ddl(rows)
    with rows_in_place(spark), shuffles_dropped(spark):
        (rows.write.bucketBy(buckets, *corpus.keys).options(**TOKENS_OPTIONS).option("path", f"{path}/tokens")
         .format("parquet").saveAsTable(f"wordlens_{uuid.uuid4().hex}"))
    tokens = open_bucketed(spark, f"{path}/tokens", columns, corpus.keys, buckets)
    shape = Corpus(tokens, corpus.keys, AnnotatedTokenizer()).shape()
    shape.select("*", F.array(*map(F.lit, corpus.keys)).alias("keys"), F.array(*map(F.lit, levels)).alias("levels"),
                 F.lit(buckets).alias("buckets"), F.lit(columns).alias("columns")).write.parquet(f"{path}/shape")
    return _opened(spark, path, tokens, ())


def open_corpus(spark: SparkSession, path: str, stat_levels: Sequence[int] = ()) -> StoredCorpus:
    """Open a stored corpus, with the statistics of ``stat_levels`` if they were written."""
    info = spark.read.parquet(f"{path}/shape").first()   # one row
    return _opened(spark, path, open_bucketed(spark, f"{path}/tokens", info["columns"], info["keys"], info["buckets"]), stat_levels)


def _opened(spark: SparkSession, path: str, tokens: DataFrame, stat_levels: Sequence[int]) -> StoredCorpus:
    info = spark.read.parquet(f"{path}/shape").first()   # one row
    return StoredCorpus(tokens, tuple(info["keys"]), AnnotatedTokenizer(), path, info, tuple(stat_levels))


def store_table(corpus: StoredCorpus, df: DataFrame, path: str) -> DataFrame:
    """Write a table of sentence keys into the buckets of ``corpus`` and open it."""
    return bucketed(df.repartition(corpus.info["buckets"], *corpus.keys), path, corpus.keys, corpus.info["buckets"])
