"""Corpus construction.

A :class:`Corpus` is a thin, immutable handle on a DataFrame in *sentence
form*: one row per sentence with its key columns, ``n_tokens`` (EOS
included) and ``_tok``, the tokeniser's per-sentence token array.  Every
other shape (long ``tokens`` rows, per-level arrays, the corpus shape) is
a lazy projection of it, so building a corpus is a scan plus narrow
``posexplode``/array expressions -- no shuffle.

Sentence keys replace the reference's list indexes: ``(doc key..., sent_no)``
with ``sent_no`` the 0-based piece number inside its document.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordlens.functions.tokenise import N_LEVELS, whitespace_units
from wordlens.session import scratch
from wordlens.sources.tokenizers import (
    LANGUAGES,
    LanguageTokenizer,
    RegexTokenizer,
    TokenizerStrategy,
)

#: sentence splitters: a text -> array of sentence strings
SPLITTERS = {
    "lines": lambda text: F.split(text, "\n", -1),
    "whitespace": whitespace_units,
    "none": lambda text: F.array(text),
    # analyser output of many sentences: one piece up to and with each line EOS
    "analysed": lambda text: F.split(text, r"(?md)(?<=^EOS)\n", -1),
}


@dataclass(frozen=True)
class Corpus:
    df: DataFrame
    keys: tuple[str, ...]
    tokenizer: TokenizerStrategy = field(default_factory=RegexTokenizer)
    #: the same sentences as they were read: keys, ``text`` and what the tokeniser needs
    raw: DataFrame | None = field(default=None, kw_only=True)

    # ------------------------------------------------------------------ shape
    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def key_cols(self) -> list[Column]:
        return [F.col(k) for k in self.keys]

    def sentences(self, with_text: bool = False) -> DataFrame:
        """``sentences`` dimension table: keys, ``n_tokens`` (A1)."""
        cols = [*self.keys, "n_tokens"] + (["text"] if with_text and "text" in self.df.columns else [])
        return self.df.select(*cols)

    def shape(self) -> DataFrame:
        """One row: ``n_sentences``, ``max_x`` (A2/A3; 0 for an empty corpus)."""
        return self.df.agg(
            F.count(F.lit(1)).alias("n_sentences"),
            F.coalesce(F.max("n_tokens"), F.lit(0)).alias("max_x"),
            F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"),
        )

    def n_sentences(self) -> Column:
        """Number of sentences as a scalar-subquery Column (evaluated once)."""
        return self.df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def longest(self) -> Column:
        """Tokens of the longest sentence as a scalar-subquery Column (0 for none)."""
        return self.df.agg(F.coalesce(F.max("n_tokens"), F.lit(0))).scalar()

    def statistics(self, level: int) -> DataFrame | None:
        """Keyword statistics kept beside the corpus, if any (see ``sources.store``)."""
        return None

    # ------------------------------------------------------------- sentence form
    def level_array(self, level: int = 0) -> Column:
        """``array<string>`` of one level for every token, EOS kept."""
        return self.tokenizer.level_array(F.col("_tok"), level)

    def word_array(self, level: int = 0) -> Column:
        """:meth:`level_array` without the end markers."""
        return self.tokenizer.word_array(F.col("_tok"), level)

    def level_form(self, level: int = 0, name: str = "t", extra: Sequence[str] = ()) -> DataFrame:
        """Sentence form of one level: keys, ``n_tokens``, ``name``."""
        return self.df.select(*self.keys, "n_tokens", *extra, self.level_array(level).alias(name))

    # ----------------------------------------------------------------- long form
    def tokens(self, levels: Sequence[int] | None = None) -> DataFrame:
        """Long form: keys, ``pos``, ``n_tokens``, ``is_eos``, ``info`` struct.

        ``levels`` restricts the struct to the levels a caller needs; the
        default carries all 30 (``f00`` .. ``f29``).
        """
        levels = list(range(N_LEVELS)) if levels is None else list(levels)
        exploded = (self.df.select(*self.keys, "n_tokens", *self.tokenizer.needs,
                                   F.posexplode_outer("_tok").alias("pos", "_e"))
                    .where(F.col("pos").isNotNull()))
        is_eos = self.tokenizer.is_eos(F.col("_e"), F.col("pos"), F.col("n_tokens"))
        return exploded.select(
            *self.keys,
            F.col("pos").cast("int").alias("pos"),
            "n_tokens",
            is_eos.alias("is_eos"),
            self.tokenizer.info(F.col("_e"), is_eos, levels).alias("info"),
        )

    def level_tokens(self, level: int = 0, name: str = "value") -> DataFrame:
        """Long form of one level: keys, ``pos``, ``n_tokens``, ``is_eos``, ``name``."""
        return self.tokens([level]).select(
            *self.keys, "pos", "n_tokens", "is_eos", F.col("info")[f"f{level:02d}"].alias(name))

    # --------------------------------------------------------------- utilities
    def with_df(self, df: DataFrame) -> Corpus:
        return Corpus(df, self.keys, self.tokenizer)

    def persist(self) -> Corpus:
        return self.with_df(self.df.persist())


def build_corpus(
    df: DataFrame,
    text_col: str = "text",
    doc_keys: Sequence[str] = ("doc_id",),
    splitter: str | Callable[[Column], Column] = "lines",
    tokenizer: TokenizerStrategy | None = None,
    keep_text: bool = False,
    partitions: int | None = None,
) -> Corpus:
    """Text table -> :class:`Corpus`.

    Each document is split into sentences (``splitter``), each sentence is
    tokenised and gets an EOS token; sentences without any token are
    dropped, but ``sent_no`` keeps the piece number from before dropping.
    Narrow: scan, generator and per-row expressions only.  ``partitions``
    asks for a redistribution of the raw rows first, for a caller who knows
    that the table is stored in fewer splits than the cluster has cores.
    """
    tokenizer = tokenizer or RegexTokenizer()
    split = splitter if callable(splitter) else SPLITTERS[splitter]
    if partitions:
        df = df.repartition(partitions)
    # Tokenise inside the sentence generator: its outputs are attributes, so
    # no later filter can be pushed below it and re-run the tokeniser
    # (outer form: Spark infers no size filter for it).
    def pieces(text: bool, tokens: bool) -> Column:
        return F.transform(split(F.col(text_col)), lambda line, i: F.struct(
            i.cast("int").alias("sent_no"),
            *([line.alias("text")] if text else []),
            *([tokenizer.prepare(line).alias("_tok")] if tokens else []),
        ))

    sent = df.select(*doc_keys, *tokenizer.needs, F.inline_outer(pieces(keep_text, True)))
    raw = df.select(*doc_keys, *tokenizer.needs, F.inline_outer(pieces(True, False))).where(F.col("text").isNotNull())
    return Corpus(counted(sent), (*doc_keys, "sent_no"), tokenizer, raw=raw)


def counted(sent: DataFrame) -> DataFrame:
    """Rows with ``_tok``: their ``n_tokens``, without those that have the end marker alone."""
    return sent.withColumn("n_tokens", F.size("_tok").cast("int")).where(F.col("n_tokens") > 1)


def read_raw(raw: DataFrame, keys: Sequence[str], tokenizer: TokenizerStrategy) -> DataFrame:
    """The sentence form of ``Corpus.raw``, in its order."""
    tok = F.inline_outer(F.array(F.struct(tokenizer.prepare(F.col("text")).alias("_tok"))))
    return counted(raw.select(*keys, *tokenizer.needs, tok))


#: splits up to which their table is broadcast (some 100 bytes each)
MOST_SPLITS = 200_000


def read_text_units(spark: SparkSession, path: str) -> DataFrame:
    """The whitespace-separated units of text file(s): ``path``, ``unit_no``, ``unit``.

    Files are read in splits, so a file of any size is spread over many tasks.  A unit never
    crosses a line end, hence never a split.  Units are numbered over the whole file, from 0:
    inside a task rows are numbered as they are read, so a unit's place in its split is its
    number less the smallest of the split, and a prefix sum over the splits of a file (one
    row each) gives the units before each split.  How a file is split follows the cores of
    the moment, so the units are written once with their split and number and both steps
    read that table; no text is shuffled.  Lines end with LF, CR or CR LF.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.explode_outer(whitespace_units(F.col("value"))).alias("unit")).where(F.col("unit").isNotNull())
    units = scratch(lines.withColumn("_n", F.monotonically_increasing_id()), "units")
    in_file = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = scratch(units.groupBy(F.col("path").alias("_path"), F.col("_block").alias("_start"))
                     .agg(F.min("_n").alias("_from"), F.count(F.lit(1)).alias("_units"))
                     .select("_path", "_start", (F.coalesce(F.sum("_units").over(in_file), F.lit(0)) - F.col("_from")).alias("_shift")), "splits")
    # one row per split: sent to every task while they are few, so that the units stay in place
    if splits.count() <= MOST_SPLITS:
        splits = F.broadcast(splits)
    return (units.join(splits, (F.col("path") == F.col("_path")) & (F.col("_block") == F.col("_start")))
            .select("path", (F.col("_n") + F.col("_shift")).alias("unit_no"), "unit"))


def read_text_corpus(spark: SparkSession, path: str,
                     tokenizer: TokenizerStrategy | None = None) -> Corpus:
    """Text file(s) split on runs of Unicode whitespace into sentences.

    Each file is one document (key ``path``); each whitespace-separated unit
    is one sentence, numbered in file order (``sent_no``, long); see :func:`read_text_units`.
    """
    tokenizer = tokenizer or RegexTokenizer()
    units = read_text_units(spark, path)
    sent = units.select("path", F.inline_outer(F.array(F.struct(
        F.col("unit_no").alias("sent_no"), F.col("unit").alias("text"), tokenizer.prepare(F.col("unit")).alias("_tok")))))
    sent = sent.withColumn("n_tokens", F.size("_tok").cast("int")).where(F.col("n_tokens") > 1)
    return Corpus(sent, ("path", "sent_no"), tokenizer)


def build_corpus_by_language(df: DataFrame, lang_col: str = "lang", text_col: str = "text",
                             doc_keys: Sequence[str] = ("doc_id",), splitter: str = "lines",
                             registry: dict[str, TokenizerStrategy] | None = None,
                             default: TokenizerStrategy | None = None, partitions: int | None = None,
                             splitters: dict[str, str] | None = None, levels: Sequence[int] = tuple(range(N_LEVELS))) -> Corpus:
    """U4: choose the tokeniser per document from its language column.

    Every document is kept: languages that are not in the registry, and a
    NULL language, take ``default``.  One scan; each row is split and read
    by its own strategy (see :class:`LanguageTokenizer`).  ``splitters`` names
    languages whose texts are split into sentences in another way than
    ``splitter``, such as ``analysed`` for analyser output.  Where analysed and
    other strategies meet, tokens carry the fields of ``levels`` (see
    :class:`MixedTokenizer`).
    """
    tokenizer = LanguageTokenizer.of(lang_col, LANGUAGES if registry is None else registry, default or RegexTokenizer(), levels)

    def split(text: Column) -> Column:
        out = SPLITTERS[splitter](text)
        for lang, other in (splitters or {}).items():
            out = F.when(F.col(lang_col) == lang, SPLITTERS[other](text)).otherwise(out)
        return out

    return build_corpus(df, text_col, doc_keys, split, tokenizer, partitions=partitions)


def wordlist_no_eos(corpus: Corpus, level: int = 0) -> DataFrame:
    """Per sentence the values of a level without EOS, in token order."""
    return corpus.df.select(*corpus.keys, corpus.word_array(level).alias("words"))


def sentence_lengths(corpus: Corpus) -> DataFrame:
    """A1: tokens (EOS included) per sentence."""
    return corpus.sentences()


def corpus_shape(corpus: Corpus) -> DataFrame:
    """A2/A3 (+ S5 counters)."""
    return corpus.shape()
