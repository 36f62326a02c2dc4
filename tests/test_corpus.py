from pyspark.sql import functions as F

from wordlens.sources.corpus import build_corpus, corpus_shape, wordlist_no_eos
from tests.conftest import by_doc


def test_lengths_and_shape(nine):
    assert by_doc(nine.sentences().collect(), "n_tokens") == [20, 20, 26, 24, 30, 47, 37, 32, 25]
    shape = corpus_shape(nine).first()
    assert (shape.n_sentences, shape.max_x, shape.n_tokens) == (9, 47, 261)


def test_tokens_long_form(nine):
    toks = nine.tokens()
    assert toks.count() == 261
    assert toks.select("info.f00").distinct().count() == 123
    eos = toks.where("is_eos").collect()
    assert len(eos) == 9 and all(r.pos == r.n_tokens - 1 for r in eos)
    assert all(r.info.f29 == "EOS" and r.info.f01 == "EOS" for r in eos)
    first = toks.where("doc_id = 0 and pos < 2").orderBy("pos").collect()
    assert [r.info.f00 for r in first] == ["これ", "に"]


def test_wordlist_without_eos(nine):
    rows = wordlist_no_eos(nine).collect()
    assert all(r.words[-1] != "EOS" for r in rows)
    assert sum(len(r.words) for r in rows) == 261 - 9


def test_line_split_keeps_piece_numbers(spark):
    df = spark.createDataFrame([(1, "a b\n\n  \nc, d")], "doc_id long, text string")
    c = build_corpus(df)
    rows = c.df.select("sent_no", "_tok").orderBy("sent_no").collect()
    assert [(r.sent_no, r._tok) for r in rows] == [(0, ["a", "b", "EOS"]), (3, ["c", ",", "d", "EOS"])]


def test_whitespace_units_unicode(spark):
    # U+3000 (ideographic space) separates units like Python's str.split()
    df = spark.createDataFrame([(1, "一つ　二つ\n三 ")], "doc_id long, text string")
    c = build_corpus(df, splitter="whitespace")
    rows = c.df.select("sent_no", "n_tokens").orderBy("sent_no").collect()
    assert [(r.sent_no, r.n_tokens) for r in rows] == [(0, 2), (1, 2), (2, 2)]


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    shape = corpus_shape(build_corpus(df)).first()
    assert (shape.n_sentences, shape.max_x) == (0, 0)


def test_regex_classes(spark):
    df = spark.createDataFrame([(1, "Hello, 42 worlds")], "doc_id long, text string")
    c = build_corpus(df)
    row = c.df.select(c.level_array(0).alias("a"), c.level_array(1).alias("b")).first()
    assert row.a == ["Hello", ",", "42", "worlds", "EOS"]
    assert row.b == ["WORD", "PUNCT", "NUM", "WORD", "EOS"]
    assert c.df.select(F.size(c.level_array(5)).alias("n")).first().n == 5
