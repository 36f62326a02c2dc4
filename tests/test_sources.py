import os
import tempfile

import pytest

from wordlens.operators import align, keywords
from wordlens.sources.annotated import AnalyserTextTokenizer
from wordlens.sources.corpus import build_corpus, build_corpus_by_language, read_text_corpus, wordlist_no_eos
from wordlens.sources.tokenizers import PresegmentedTokenizer, RegexTokenizer


def test_read_text_corpus_whitespace_units(spark):
    folder = tempfile.mkdtemp(prefix="wl-text-")
    path = os.path.join(folder, "sample.txt")
    with open(path, "w", encoding="utf-8") as fh:
        # two units on the first line (ideographic space), one with two sentences inside
        fh.write("これは本です。　それはペンです。あれは鉛筆です。\n\n  最後の文。\n")
    c = read_text_corpus(spark, path)
    rows = c.df.select("sent_no", "text", "n_tokens").orderBy("sent_no").collect()
    assert [r.sent_no for r in rows] == [0, 1, 2]
    assert rows[1].text == "それはペンです。あれは鉛筆です。"   # no split at 。 inside a unit
    assert all(r.n_tokens >= 2 for r in rows)


def test_corpus_by_language(spark):
    df = spark.createDataFrame([(1, "en", "a b"), (2, "de", "c d e"), (3, "xx", "f")],
                               "doc_id long, lang string, text string")
    c = build_corpus_by_language(df)
    assert sorted(r.doc_id for r in c.df.select("doc_id").collect()) == [1, 2, 3]


def test_corpus_by_language_keeps_every_row_and_strategy(spark):
    df = spark.createDataFrame([(1, "en", "a-b c"), (2, "xx", "a-b c"), (3, None, "a-b c")],
                               "doc_id long, lang string, text string")
    c = build_corpus_by_language(df, registry={"xx": PresegmentedTokenizer()})
    words = {r.doc_id: r.words for r in wordlist_no_eos(c).collect()}
    assert words == {1: ["a", "-", "b", "c"], 2: ["a-b", "c"], 3: ["a", "-", "b", "c"]}
    toks = {(r.doc_id, r.pos): r.info.f01 for r in c.tokens([0, 1]).collect()}
    assert toks[(1, 1)] == "PUNCT" and toks[(2, 0)] == "WORD" and toks[(2, 2)] == "EOS"
    assert keywords.keyword_stats(c, 1).where("term = 'EOS'").first().binary == 3
    centred = align.centre_word(c, "c", levels=[0, 1]).collect()
    assert all(r.l0 == ["c", "EOS"] and r.l1 == ["WORD", "EOS"] for r in centred)


def test_conversation_keys_use_struct_first_seen(spark):
    df = spark.createDataFrame([(1, 0, "b a"), (1, 1, "a c"), (0, 5, "c")], "conv_id long, turn long, text string")
    c = build_corpus(df, "text", ("conv_id", "turn"), tokenizer=RegexTokenizer())
    rows = keywords.sort_keywords(c, "binary").orderBy("sort_rank").collect()
    # a and c and EOS tie on binary 2..3; first appearance orders ties: (0,5) before (1,0)
    assert [r.term for r in rows] == ["EOS", "c", "a", "b"]


def test_mixed_strategies_in_one_corpus(spark):
    analysed = "\n".join([annotated_line("日本"), annotated_line("12", "数詞"), "EOS", annotated_line("EOS"), "EOS", "bad\tline", "EOS", "EOS"])
    rows = [(1, "ja", analysed), (2, "en", "Two words\nEOS 3"), (3, None, "x"), (4, "ja", None), (5, "en", None), (6, "ja", "")]
    c = build_corpus_by_language(spark.createDataFrame(rows, "doc_id long, lang string, text string"),
                                 registry={"ja": AnalyserTextTokenizer()}, splitters={"ja": "analysed"}, levels=(0, 1, 2))
    got = {}
    for r in c.tokens([0, 1, 2]).orderBy("doc_id", "sent_no", "pos").collect():
        got.setdefault((r["doc_id"], r["sent_no"]), []).append((r["info"]["f00"], r["info"]["f01"], r["info"]["f02"], r["is_eos"]))
    end = ("EOS", "EOS", "EOS", True)
    assert got == {
        (1, 0): [("日本", "名詞", "一般", False), ("12", "名詞", "数詞", False), end],
        (1, 1): [("EOS", "名詞", "一般", False), end],
        (2, 0): [("Two", "WORD", None, False), ("words", "WORD", None, False), end],
        (2, 1): [("EOS", "WORD", None, False), ("3", "NUM", None, False), end],
        (3, 0): [("x", "WORD", None, False), end]}
    words = {(r["doc_id"], r["sent_no"]): r["words"] for r in wordlist_no_eos(c).collect()}
    assert words[1, 1] == ["EOS"] and words[1, 0] == ["日本", "12"] and words[2, 1] == ["EOS", "3"]
    strict = build_corpus_by_language(c.spark.createDataFrame(rows, "doc_id long, lang string, text string"),
                                      registry={"ja": AnalyserTextTokenizer("failfast")}, splitters={"ja": "analysed"}, levels=(0,))
    with pytest.raises(Exception, match="could not be normalised"):
        strict.df.collect()


def annotated_line(surface, kind="一般"):
    return surface + "\t" + ",".join(["名詞", kind] + ["*"] * 27)


def test_mixed_corpus_reads_the_asked_levels_only(spark):
    df = spark.createDataFrame([(0, "ja", "a\t" + ",".join("x" * 29) + "\nEOS"), (1, "en", "b c")], "doc_id long, lang string, text string")
    c = build_corpus_by_language(df, registry={"ja": AnalyserTextTokenizer()}, splitters={"ja": "analysed"}, levels=(0, 2))
    assert [[t["f00"] for t in r["_tok"]] for r in c.df.orderBy("doc_id").collect()] == [["a", "EOS"], ["b", "c", "EOS"]]
    assert "f29" not in c.df._jdf.queryExecution().executedPlan().toString()
