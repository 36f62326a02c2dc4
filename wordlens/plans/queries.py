"""Registered queries: one per operator of the inventory, on the driver tables.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input table.  Results are flat rows (arrays are rendered as
comma-joined strings, averages rounded to 6 decimals) so that the SQL
oracle in :mod:`wordlens.plans.oracle` can reproduce them exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.functions.arrays import percent
from wordlens.functions.tokenise import PUNCT, WORD
from wordlens.operators import align, distance, keywords, positions, project, reshape
from wordlens.plans import params as P
from wordlens.session import read_table, scratch_path
from wordlens.sources import annotated
from wordlens.sources.corpus import Corpus, build_corpus, build_corpus_by_language, corpus_shape, read_text_corpus, wordlist_no_eos
from wordlens.sources.index import PositionalIndex, build_index
from wordlens.sources.store import StoredCorpus, store_corpus, store_table
from wordlens.sources.tokenizers import PresegmentedTokenizer, RegexTokenizer

Builder = Callable[[SparkSession, str], DataFrame]
KEYS = ["doc_id", "sent_no"]


#: session setting for tables stored in fewer splits than there are cores; unset: no redistribution
INPUT_PARTITIONS = "wordlens.input.partitions"


def input_partitions(spark: SparkSession) -> int | None:
    value = spark.conf.get(INPUT_PARTITIONS, None)
    return int(value) if value else None


def documents_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    return build_corpus(read_table(spark, sf_dir, "documents"), partitions=input_partitions(spark))


def conversations_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    return build_corpus(read_table(spark, sf_dir, "conversations"), "text", ("conv_id", "turn"),
                        partitions=input_partitions(spark))


_STORED: dict[tuple[str, str], StoredCorpus] = {}
_INDEXED: dict[tuple[str, str], PositionalIndex] = {}


def stored_documents(spark: SparkSession, sf_dir: str) -> StoredCorpus:
    """``documents`` tokenised and written once for all queries of this application."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _STORED:
        _STORED[key] = store_corpus(documents_corpus(spark, sf_dir), scratch_path(spark, "corpus"), levels=(0, 1))
    return _STORED[key]


def indexed_documents(spark: SparkSession, sf_dir: str) -> PositionalIndex:
    """The positional index of ``documents``, written once as well."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _INDEXED:
        _INDEXED[key] = build_index(documents_corpus(spark, sf_dir), scratch_path(spark, "index"))
    return _INDEXED[key]


def _r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _joined(arr: Column, sep: str = " ") -> Column:
    return F.array_join(arr, sep)


# ---------------------------------------------------------------- corpus


def q_sentences(spark, sf_dir):
    return documents_corpus(spark, sf_dir).sentences()


def q_tokens(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    return c.tokens([0, 1]).select(*KEYS, "pos", "n_tokens", "is_eos",
                                   F.col("info.f00").alias("f00"), F.col("info.f01").alias("f01"))


def q_sentence_lengths(spark, sf_dir):
    return conversations_corpus(spark, sf_dir).sentences()


def q_corpus_shape(spark, sf_dir):
    return corpus_shape(documents_corpus(spark, sf_dir))


def q_wordlist_no_eos(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    return wordlist_no_eos(c).select(*KEYS, _joined(F.col("words")).alias("words"))


def q_whitespace_sentences(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    c = build_corpus(docs, splitter="whitespace")
    return c.sentences()


def q_text_units(spark, sf_dir):
    """S1 over text files: every 1,000 documents are one file, in order of their ids; units are
    numbered over each whole file."""
    docs = read_table(spark, sf_dir, "documents").select(
        F.expr(f"doc_id div {P.FILE_DOCS}").alias("batch"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    path = scratch_path(spark, "texts")
    docs.repartition("batch").sortWithinPartitions("batch", "doc_id").select("batch", "text").write.partitionBy("batch").text(path)
    c = read_text_corpus(spark, path)
    batch = F.regexp_extract("path", "/batch=([0-9]+)/", 1).cast("long")
    return c.sentences().select(batch.alias("batch"), F.col("sent_no").alias("unit_no"), "n_tokens")


def q_language_tokens(spark, sf_dir):
    """U4: two languages read as whitespace-separated, the rest by the default strategy."""
    registry = {lang: PresegmentedTokenizer() for lang in P.PRESEGMENTED_LANGUAGES}
    c = build_corpus_by_language(read_table(spark, sf_dir, "documents"), registry=registry,
                                 partitions=input_partitions(spark))
    return c.tokens([0]).select(*KEYS, "pos", "n_tokens", "is_eos", F.col("info.f00").alias("f00"))


def q_mixed_language_tokens(spark, sf_dir):
    """U4: one language comes as analyser output (derived by Spark), the others as plain text."""
    docs = read_table(spark, sf_dir, "documents")
    analysed = F.array_join(F.transform(F.split("text", "\n", -1), lambda line: F.array_join(F.transform(
        F.array(RegexTokenizer().prepare(line)), lambda t: F.transform(t, lambda x, i: _analyser_line(x, i == F.size(t) - 1, False)))[0], "\n")), "\n")
    own = F.col("lang") == P.ANALYSED_LANGUAGE
    c = build_corpus_by_language(docs.withColumn("text", F.when(own, analysed).otherwise(F.col("text"))),
                                 registry={P.ANALYSED_LANGUAGE: annotated.AnalyserTextTokenizer()},
                                 splitters={P.ANALYSED_LANGUAGE: "analysed"}, levels=(0, 1, 2), partitions=input_partitions(spark))
    return c.tokens([0, 1, 2]).select(*KEYS, "pos", "n_tokens", "is_eos", "info.f00", "info.f01", "info.f02")


# -------------------------------------------------------------- keywords


def _stats_cols(df: DataFrame) -> DataFrame:
    return df.select("term", "binary", "count", "quote",
                     _r6("pos_index").alias("pos_index"), _r6("pct_index").alias("pct_index"))


def q_term_counts(spark, sf_dir):
    return keywords.term_counts(documents_corpus(spark, sf_dir))


def q_vocabulary_index(spark, sf_dir):
    return keywords.vocabulary_index(documents_corpus(spark, sf_dir))


def q_term_vectors(spark, sf_dir):
    v = keywords.term_vectors(stored_documents(spark, sf_dir))
    return v.select(*KEYS, "n_terms", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
                    F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


def q_word_occurrence(spark, sf_dir):
    return keywords.word_occurrence(documents_corpus(spark, sf_dir), P.WORD)


def q_keyword_stats(spark, sf_dir):
    return _stats_cols(keywords.keyword_stats(documents_corpus(spark, sf_dir)))


def q_keyword_filter(spark, sf_dir):
    stats = keywords.keyword_stats(documents_corpus(spark, sf_dir))
    return _stats_cols(keywords.filter_stats(stats, F.col("binary") >= P.FILTER_MIN_BINARY))


def q_keyword_sorted(spark, sf_dir):
    s = keywords.sort_keywords(documents_corpus(spark, sf_dir), "binary")
    return s.select(F.col("sort_rank").cast("long").alias("sort_rank"), "term", "binary", "count")


def q_position_index(spark, sf_dir):
    s = keywords.position_index_by_term(documents_corpus(spark, sf_dir))
    return s.select("term", _r6("pos_index").alias("pos_index"))


def q_position_index_pct(spark, sf_dir):
    s = keywords.position_index_by_term(documents_corpus(spark, sf_dir), in_percent=True)
    return s.select("term", _r6("pct_index").alias("pct_index"))


def q_keyword_report(spark, sf_dir):
    rep = keywords.keyword_report(documents_corpus(spark, sf_dir), P.REPORT_PERCENT)
    return rep.select("rank", "term", "binary", "count", "quote",
                      _r6("pos_index").alias("pos_index"), _r6("pct_index").alias("pct_index"))


def q_recentred_report(spark, sf_dir):
    """T2 after W7: every sentence counts, also those without the word."""
    c = align.recentred_corpus(documents_corpus(spark, sf_dir), P.WORD)
    rep = keywords.keyword_report(c, P.RECENTRED_REPORT_PERCENT)
    return rep.select("rank", "term", "binary", "count", "quote",
                      _r6("pos_index").alias("pos_index"), _r6("pct_index").alias("pct_index"))


def q_conversation_report(spark, sf_dir):
    rep = keywords.keyword_report(conversations_corpus(spark, sf_dir), P.REPORT_PERCENT)
    return rep.select("rank", "term", "binary", "count", "quote", _r6("pos_index").alias("pos_index"))


def q_word_stats(spark, sf_dir):
    return keywords.binary_count_quote(documents_corpus(spark, sf_dir), P.WORD)


def q_keyword_at_least(spark, sf_dir):
    stats = keywords.keyword_stats(documents_corpus(spark, sf_dir))
    return _stats_cols(keywords.select_all_with_count(stats, "count", P.FILTER_MIN_COUNT))


def q_keyword_drilldown(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    rep = keywords.keyword_report(c, P.REPORT_PERCENT)
    d = keywords.keyword_drilldown(c, rep, rank=P.DRILL_RANK)
    return d.select("rank", "term", *KEYS, F.array_join("positions", ",").alias("positions"))


def q_main_element(spark, sf_dir):
    return keywords.main_element(documents_corpus(spark, sf_dir), share=P.MAIN_SHARE)


# ------------------------------------------------------------ projections


def q_level_values(spark, sf_dir):
    return project.level_values(documents_corpus(spark, sf_dir), 1)


def q_level_window(spark, sf_dir):
    return project.level_window(documents_corpus(spark, sf_dir), P.WINDOW_START, P.WINDOW_STOP)


def q_level_per_sentence(spark, sf_dir):
    d = project.level_per_sentence(documents_corpus(spark, sf_dir), 1)
    return d.select(*KEYS, _joined(F.col("values")).alias("line"))


def q_show_level(spark, sf_dir):
    return project.show_level(documents_corpus(spark, sf_dir), 1)


def q_sub_sentence_long(spark, sf_dir):
    tokens = documents_corpus(spark, sf_dir).level_tokens(0)
    return project.sub_sentence_long(tokens, P.SUB_START, P.SUB_STOP).select(*KEYS, "pos", "value")


def q_sub_sentence(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    d = project.sub_sentence(c.level_form(0, "t"), "t", P.SUB_START, P.SUB_STOP)
    return d.select(*KEYS, _joined(F.col("t")).alias("sub"))


def q_trim_pad(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    d = project.trim_sentence_to_length(c.level_form(0, "t"), "t", P.TRIM_LEN)
    return d.select(*KEYS, _joined(F.col("t")).alias("trimmed"))


def q_map_values(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    d = project.map_values(c.level_form(0, "t"), ["t"], lambda x: F.length(x), depth=1)
    return d.select(*KEYS, F.array_join("t", ",").alias("lengths"))


# -------------------------------------------------------------- positions


def q_positions_abs(spark, sf_dir):
    d = positions.positions_abs(documents_corpus(spark, sf_dir), P.WORD)
    return d.select(*KEYS, F.array_join("positions", ",").alias("positions"))


def q_positions_pct(spark, sf_dir):
    d = positions.positions_pct(documents_corpus(spark, sf_dir), P.WORD)
    return positions.explode_positions(d, KEYS).select(
        *KEYS, F.col("hit_no").cast("int").alias("hit_no"), _r6("position").alias("pct"))


def q_wordlist_abs(spark, sf_dir):
    d = positions.wordlist_abs(documents_corpus(spark, sf_dir), P.WORDS)
    return d.select("word_no", "term", *KEYS, F.array_join("positions", ",").alias("positions"))


def q_wordlist_pct(spark, sf_dir):
    d = positions.wordlist_pct(documents_corpus(spark, sf_dir), P.WORDS)
    return d.select("word_no", *KEYS, F.posexplode_outer("positions").alias("hit_no", "pct")).where(
        F.col("hit_no").isNotNull()).select(
        "word_no", *KEYS, F.col("hit_no").cast("int").alias("hit_no"), _r6("pct").alias("pct"))


def q_show_positions(spark, sf_dir):
    d = positions.show_positions(documents_corpus(spark, sf_dir), P.WORD)
    return d.select(*KEYS, "n_tokens", F.array_join("positions", ",").alias("positions"))


def q_wordlist_hits(spark, sf_dir):
    d = positions.wordlist_abs(documents_corpus(spark, sf_dir), P.WORDS, aligned=False)
    return d.select("word_no", "term", *KEYS, F.array_join("positions", ",").alias("positions"))


def q_wordlist_table(spark, sf_dir):
    """W3 for the words of ``benchmark``, a table of any length, against ``documents``."""
    words = keywords.vocabulary_index(build_corpus(read_table(spark, sf_dir, "benchmark"), "text", ("item_id",)))
    d = positions.wordlist_table(documents_corpus(spark, sf_dir), words.select(F.col("idx").alias("word_no"), "term"))
    return d.select("word_no", "term", *KEYS, F.array_join("positions", ",").alias("positions"))


def q_index_wordlist(spark, sf_dir):
    d = indexed_documents(spark, sf_dir).hits(P.WORDS)
    return d.select("word_no", "term", *KEYS, F.array_join("positions", ",").alias("positions"))


def q_index_occurrence(spark, sf_dir):
    return indexed_documents(spark, sf_dir).occurrence(documents_corpus(spark, sf_dir).sentences(), P.WORD)


# ----------------------------------------------------------- stored corpus


def q_stored_padded_sentences(spark, sf_dir):
    d = reshape.padded_sentences(stored_documents(spark, sf_dir))
    return d.select(*KEYS, _joined(F.col("values")).alias("values"), "pad_value", "pad_count")


def q_stored_drilldown(spark, sf_dir):
    """T3 from stored statistics: the report is a table of one row per term, the text is read once."""
    c = stored_documents(spark, sf_dir)
    if 0 not in c.stat_levels:
        c = _STORED[spark.sparkContext.applicationId, sf_dir] = keywords.store_statistics(c)
    d = keywords.keyword_drilldown(c, keywords.keyword_report(c, P.REPORT_PERCENT), rank=P.DRILL_RANK)
    return d.select("rank", "term", *KEYS, F.array_join("positions", ",").alias("positions"))


def q_stored_centre_by_positions(spark, sf_dir):
    """W5 with a table of positions in the buckets of the corpus: no exchange."""
    c = stored_documents(spark, sf_dir)
    pos = store_table(c, positions.positions_abs(c, P.WORD).select(*KEYS, "positions"), scratch_path(spark, "positions"))
    d = align.centre_at_positions(c, pos, 1, levels=(0,))
    return d.select(*KEYS, _joined(F.col("l0")).alias("centred"))


# -------------------------------------------------------------- alignment


def _centre(spark, sf_dir, direction):
    d = align.centre_at_word(documents_corpus(spark, sf_dir), P.WORD, direction)
    return d.select(*KEYS, _joined(F.col("l0")).alias("centred"))


def q_centre_by_positions(spark, sf_dir):
    """W5 with a table of positions, as another corpus or tool may give it: a join on the key."""
    c = documents_corpus(spark, sf_dir)
    pos = positions.positions_abs(c, P.WORD).select(*KEYS, "positions")
    d = align.centre_at_positions(c, pos, 1, levels=(0,))
    return d.select(*KEYS, _joined(F.col("l0")).alias("centred"))


def q_centre_suffix(spark, sf_dir):
    return _centre(spark, sf_dir, 1)


def q_centre_prefix(spark, sf_dir):
    return _centre(spark, sf_dir, 0)


def q_centre_reversed(spark, sf_dir):
    return _centre(spark, sf_dir, -1)


def q_centre_word(spark, sf_dir):
    d = align.centre_word(documents_corpus(spark, sf_dir), P.WORD)
    return d.select(*KEYS, F.size("l0").alias("n"), _joined(F.col("l0")).alias("centred"))


def q_recentred_corpus(spark, sf_dir):
    c = align.recentred_corpus(documents_corpus(spark, sf_dir), P.WORD)
    return _stats_cols(keywords.keyword_stats(c))


def q_slot_values(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    return align.slot_values(align.centre_word(c, P.WORD, levels=[0, 1]), KEYS, [0, 1])


def q_slot_frequency(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    centred = align.centre_word(c, P.WORD, levels=[0, 1])
    return align.slot_frequency(centred, KEYS, [0, 1])


def q_element_counts(spark, sf_dir):
    c = documents_corpus(spark, sf_dir)
    slot = align.centre_word(c, P.WORD).where(F.size("l0") > 1).select(F.get("l0", F.lit(1)).alias("value"))
    return align.element_counts(slot, "value")


# --------------------------------------------------------------- distance


def q_distance(spark, sf_dir):
    d = distance.distance(documents_corpus(spark, sf_dir), P.WORDS)
    return d.select(*KEYS, "i", "j", "k", "distance", "n_j", F.array_join("sizes", ",").alias("sizes"))


def q_distance_cube(spark, sf_dir):
    d = distance.distance(documents_corpus(spark, sf_dir), P.CUBE_WORDS, expand=True)
    return d.select(*KEYS, "i", "j", "c", "distance")


def q_distance_cells(spark, sf_dir):
    d = distance.distance_cells(documents_corpus(spark, sf_dir), P.CELL_WORDS, P.CELL_FIRST, P.CELL_LAST)
    return d.select(*KEYS, "i", "j", "c", "distance")


# ---------------------------------------------------------------- reshape


def q_padded_sentences(spark, sf_dir):
    d = reshape.padded_sentences(documents_corpus(spark, sf_dir))
    return d.select(*KEYS, _joined(F.col("values")).alias("values"), "pad_value", "pad_count")


def q_axes_moved(spark, sf_dir):
    return reshape.axes_moved_counts(documents_corpus(spark, sf_dir), [0])


def q_axes_moved_long(spark, sf_dir):
    """R2 (long form) of the class level of the conversations, whose sentences are short."""
    d = reshape.axes_moved(conversations_corpus(spark, sf_dir), [1])
    return d.select("pos", "level", "conv_id", "turn", "sent_no", "value")


def q_axes_moved_intervals(spark, sf_dir):
    """R2 as intervals: the class level of every document."""
    return reshape.axes_moved_intervals(documents_corpus(spark, sf_dir), [1])


def q_axes_moved_interval_counts(spark, sf_dir):
    """R2 with A9 from intervals: sentences by surface and range of positions."""
    return reshape.interval_counts(reshape.axes_moved_intervals(documents_corpus(spark, sf_dir), [0]))


def q_ragged_transpose_long(spark, sf_dir):
    from wordlens.functions.tokenise import regex_tokens
    docs = read_table(spark, sf_dir, "documents")
    m = docs.select("doc_id", F.transform(F.split("text", "\n", -1), lambda ln: regex_tokens(ln)).alias("m"))
    return reshape.ragged_transpose_long(m, "m", ["doc_id"])


def q_ragged_transpose(spark, sf_dir):
    """Per document: the matrix sentence x token of surfaces, transposed to token x sentence."""
    docs = read_table(spark, sf_dir, "documents")
    from wordlens.functions.tokenise import regex_tokens
    m = docs.select("doc_id", F.transform(F.split("text", "\n", -1), lambda ln: regex_tokens(ln)).alias("m"))
    t = reshape.ragged_transpose(m, "m", F.lit("_"))
    return t.select("doc_id", F.posexplode_outer("m").alias("col", "cells")).where(
        F.col("col").isNotNull()).select(
        "doc_id", F.col("col").cast("int").alias("col"), F.array_join("cells", " ").alias("cells"))


def q_rotated_sentence(spark, sf_dir):
    d = reshape.rotated_sentence(documents_corpus(spark, sf_dir), [0, 1])
    return d.select(*KEYS, "level", _joined(F.col("values")).alias("values"))


# -------------------------------------------------------- annotated input


def _analyser_line(x: Column, is_eos: Column, faults: bool) -> Column:
    """The analyser line of a token.

    Words get 29 feature fields, the 7th of them quoted with a comma inside
    (exercises the quote repair); numbers get the 6-feature short form with
    ``数詞`` as field 2 (exercises the padding rule); symbols get 29 plain
    fields.  Field 1 is the token class.  With ``faults`` the symbols of
    ``params`` get the two other padded forms and the two forms that are
    rejected.
    """
    # the class that token_class gives, looked at once
    fields = lambda cls: F.lit(cls + ",*" * 28)
    quoted = F.concat(F.lit(WORD + ",*" * 5 + ',"'), x, F.lit(',x"' + ",*" * 22))
    feats = F.when(x.rlike(r"^\p{L}"), quoted).when(x.rlike(r"^\p{N}"), F.lit(P.SHORT_NUMERAL)).otherwise(fields(PUNCT))
    if faults:
        for symbol, form in P.SYMBOL_FORMS.items():
            feats = F.when(x == symbol, F.lit(form)).otherwise(feats)
    return F.when(is_eos, F.lit("EOS")).otherwise(F.concat(x, F.lit("\t"), feats))


def derived_analyser_output(spark, sf_dir, faults: bool = False) -> DataFrame:
    """Analyser-format strings derived from ``documents`` by Spark, one per sentence."""
    c = documents_corpus(spark, sf_dir)
    return c.df.select(*KEYS, F.array_join(F.transform(
        "_tok", lambda x, i: _analyser_line(x, i == F.col("n_tokens") - 1, faults)), "\n").alias("analysis"))


def derived_analyser_lines(spark, sf_dir, faults: bool = False) -> DataFrame:
    """The same lines, one per row."""
    t = documents_corpus(spark, sf_dir).level_tokens(0)
    return t.select(*KEYS, F.col("pos").alias("line_no"), _analyser_line(F.col("value"), F.col("is_eos"), faults).alias("raw_line"))


def q_annotated_stats(spark, sf_dir):
    rows, _rejects = annotated.parse_token_rows(derived_analyser_lines(spark, sf_dir), levels=(1, 2))
    return rows.statistics().select(
        F.when(F.col("level") == 2, F.concat(F.lit("f02:"), F.col("term"))).otherwise(F.col("term")).alias("term"),
        "binary", "count")


def q_annotated_rejects(spark, sf_dir):
    _corpus, rejects = annotated.parse_analyser_output(derived_analyser_output(spark, sf_dir, faults=True))
    return rejects


def q_annotated_padding(spark, sf_dir):
    """The sentences that stay beside the rejected ones: padded and end fields."""
    corpus, _rejects = annotated.parse_analyser_output(derived_analyser_output(spark, sf_dir, faults=True), levels=(1, 2, 29))
    return keywords.keyword_stats_levels(corpus, [1, 2, 29]).select("level", "term", "binary", "count")


QUERIES: dict[str, Builder] = {
    # corpus
    "sentences": q_sentences,
    "tokens": q_tokens,
    "sentence_lengths": q_sentence_lengths,
    "corpus_shape": q_corpus_shape,
    "wordlist_no_eos": q_wordlist_no_eos,
    "whitespace_sentences": q_whitespace_sentences,
    "text_units": q_text_units,
    "language_tokens": q_language_tokens,
    "mixed_language_tokens": q_mixed_language_tokens,
    # keywords
    "term_counts": q_term_counts,
    "vocabulary_index": q_vocabulary_index,
    "word_occurrence": q_word_occurrence,
    "term_vectors": q_term_vectors,
    "keyword_stats": q_keyword_stats,
    "keyword_filter": q_keyword_filter,
    "keyword_sorted": q_keyword_sorted,
    "position_index": q_position_index,
    "position_index_pct": q_position_index_pct,
    "keyword_report": q_keyword_report,
    "recentred_report": q_recentred_report,
    "conversation_report": q_conversation_report,
    "word_stats": q_word_stats,
    "keyword_at_least": q_keyword_at_least,
    "keyword_drilldown": q_keyword_drilldown,
    "main_element": q_main_element,
    # projections
    "level_values": q_level_values,
    "level_window": q_level_window,
    "level_per_sentence": q_level_per_sentence,
    "show_level": q_show_level,
    "sub_sentence": q_sub_sentence,
    "sub_sentence_long": q_sub_sentence_long,
    "trim_pad": q_trim_pad,
    "map_values": q_map_values,
    # positions
    "positions_abs": q_positions_abs,
    "positions_pct": q_positions_pct,
    "wordlist_abs": q_wordlist_abs,
    "wordlist_pct": q_wordlist_pct,
    "wordlist_hits": q_wordlist_hits,
    "wordlist_table": q_wordlist_table,
    "index_wordlist": q_index_wordlist,
    "index_occurrence": q_index_occurrence,
    "show_positions": q_show_positions,
    # stored corpus
    "stored_padded_sentences": q_stored_padded_sentences,
    "stored_drilldown": q_stored_drilldown,
    "stored_centre_by_positions": q_stored_centre_by_positions,
    # alignment
    "centre_suffix": q_centre_suffix,
    "centre_prefix": q_centre_prefix,
    "centre_reversed": q_centre_reversed,
    "centre_by_positions": q_centre_by_positions,
    "centre_word": q_centre_word,
    "recentred_corpus": q_recentred_corpus,
    "slot_values": q_slot_values,
    "slot_frequency": q_slot_frequency,
    "element_counts": q_element_counts,
    # distance
    "distance": q_distance,
    "distance_cube": q_distance_cube,
    "distance_cells": q_distance_cells,
    # reshape
    "padded_sentences": q_padded_sentences,
    "axes_moved": q_axes_moved,
    "axes_moved_long": q_axes_moved_long,
    "axes_moved_intervals": q_axes_moved_intervals,
    "axes_moved_interval_counts": q_axes_moved_interval_counts,
    "ragged_transpose": q_ragged_transpose,
    "ragged_transpose_long": q_ragged_transpose_long,
    "rotated_sentence": q_rotated_sentence,
    # annotated input
    "annotated_stats": q_annotated_stats,
    "annotated_rejects": q_annotated_rejects,
    "annotated_padding": q_annotated_padding,
}
