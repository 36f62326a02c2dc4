import random

import pytest

from wordlens.operators import keywords, project
from wordlens.sources.analyser import analyse
from wordlens.sources.annotated import lines_to_sentences, parse_analyser_output, parse_token_rows, sentence_lines, to_analyser_format
from wordlens.sources.corpus import wordlist_no_eos

F29 = ",".join(f"x{i}" for i in range(1, 30))


def _parse(spark, text, mode="quarantine"):
    df = spark.createDataFrame([(1, 0, text)], "doc_id long, sent_no int, analysis string")
    return parse_analyser_output(df, mode=mode)


def test_regular_eos_and_padding(spark):
    text = "\n".join([
        "煎茶\t" + F29,
        "２７３\t名詞,数詞,a,b,c,d",
        "foo\t名詞,普通名詞,a,b,c,d",
        "bar\t感動詞,x,a,b,c,d",
        "EOS",
    ]) + "\n"
    corpus, rejects = _parse(spark, text)
    tok = corpus.df.first()._tok
    assert rejects.count() == 0
    assert len(tok) == 5 and all(len(t) == 31 for t in tok)
    assert tok[0][0] == "煎茶" and tok[0][29] == "x29"
    assert tok[1][:3] == ("２７３", "名詞", "数詞") and tok[1][7:30] == ("",) * 23
    assert tok[4][:30] == ("EOS",) * 30 and [t.is_eos for t in tok] == [False] * 4 + [True]


def test_quote_repair(spark):
    fields = [f"x{i}" for i in range(1, 29)] + ['"a,b"']
    corpus, rejects = _parse(spark, "s\t" + ",".join(fields) + "\nEOS")
    tok = corpus.df.first()._tok
    assert rejects.count() == 0 and tok[0][29] == '"a,b"'


def test_quote_with_thirty_pieces_not_repaired(spark):
    fields = [f"x{i}" for i in range(1, 28)] + ['"a', 'b"']
    corpus, _ = _parse(spark, "s\t" + ",".join(fields) + "\nEOS")
    tok = corpus.df.first()._tok
    assert tok[0][28:30] == ('"a', 'b"')


def test_rejects(spark):
    bad_quote = "s\t" + ",".join([f"x{i}" for i in range(1, 29)] + ['"a,b', "c"])
    unknown = "s\tA,B,C,D,E,F"
    corpus, rejects = _parse(spark, "\n".join(["ok\t" + F29, bad_quote, unknown, "EOS"]))
    assert corpus.df.count() == 0
    got = sorted((r.line_no, r.reason) for r in rejects.collect())
    # every line of the sentence is there
    assert got == [(0, "sentence_rejected"), (1, "unclosed_quote"), (2, "unknown_type"), (3, "sentence_rejected")]
    with pytest.raises(Exception):
        _parse(spark, unknown + "\nEOS", mode="failfast")[0].df.collect()


def test_no_sentence_is_lost(spark):
    rows = [(1, "a\t" + F29), (2, "EOS"), (3, ""), (4, None), (5, f"a\t{F29}\nEOS\nb\t{F29}"), (6, "EOS\t" + F29)]
    df = spark.createDataFrame([(i, 0, t) for i, t in rows], "doc_id long, sent_no int, analysis string")
    corpus, rejects = parse_analyser_output(df)
    assert sorted(r.doc_id for r in corpus.df.collect()) == [1, 2, 5, 6]
    assert sorted((r.doc_id, r.raw_line, r.reason) for r in rejects.collect()) == [
        (3, "", "unknown_type"), (4, "", "unknown_type")]
    # the end marker is a line of its own, wherever it stands; a word may read the same
    words = {r.doc_id: r.words for r in wordlist_no_eos(corpus).collect()}
    assert words == {1: ["a"], 2: [], 5: ["a", "b"], 6: ["EOS"]}
    values = [(r.doc_id, r.value) for r in project.level_values(corpus).orderBy("doc_id", "pos").collect()]
    assert values == [(1, "a"), (5, "a"), (5, "b"), (6, "EOS")]


def test_control_character_in_a_quoted_field(spark):
    fields = [f"x{i}" for i in range(1, 29)] + ['"a\u0001,b"']
    corpus, _ = _parse(spark, "s\t" + ",".join(fields) + "\nEOS")
    assert corpus.df.first()._tok[0][29] == '"a\u0001,b"'


def test_round_trip_and_lines(nine, spark):
    analysed = to_analyser_format(nine)
    corpus, rejects = parse_analyser_output(analysed, keys=list(nine.keys))
    assert rejects.count() == 0
    a = {(r.term, r.binary, r["count"]) for r in keywords.keyword_stats(corpus).collect()}
    b = {(r.term, r.binary, r["count"]) for r in keywords.keyword_stats(nine).collect()}
    assert a == b
    lines = spark.createDataFrame([(1, 0, 1, "b\t" + F29), (1, 0, 0, "a\t" + F29), (1, 0, 2, "EOS")],
                                  "doc_id long, sent_no int, line_no int, raw_line string")
    c2, _ = parse_analyser_output(lines_to_sentences(lines))
    assert [t[0] for t in c2.df.first()._tok] == ["a", "b", "EOS"]


def test_external_analyser_stub(spark):
    feats = F29

    class _StubTagger:  # defined here so that it is shipped to the Python worker by value
        def parse(self, text):
            return "\n".join(f"{ch}\t" + feats for ch in text) + "\nEOS\n"

    df = spark.createDataFrame([(1, 0, "お煎茶")], "doc_id long, sent_no int, text string")
    corpus, rejects = analyse(df, _StubTagger)
    tok = corpus.df.first()._tok
    assert [t[0] for t in tok] == ["お", "煎", "茶", "EOS"] and rejects.count() == 0


ODD_SENTENCES = [
    "煎茶\t" + F29 + "\n２７３\t名詞,数詞,a,b,c,d\nfoo\t名詞,普通名詞,a,b,c,d\nbar\t感動詞,x,a,b,c,d\nEOS\n",
    "s\t" + ",".join([*[f"x{i}" for i in range(1, 29)], '"a,b"']) + "\nEOS",                  # repaired
    "s\t" + ",".join([*[f"x{i}" for i in range(1, 28)], '"a', 'b"']) + "\nEOS",               # 30 raw pieces: not repaired
    "s\t" + ",".join([*[f"x{i}" for i in range(1, 26)], '"a,b"', 'x"c,d"y', "", ""]) + "\nEOS",
    "s\t" + ",".join([f"x{i}" for i in range(1, 29)] + ['"a,b', "c"]) + "\nok\t" + F29,        # unclosed
    "ok\t" + F29 + "\ns\tA,B,C,D,E,F\nEOS", "EOS", "", None, " \n ", "EOS\t" + F29, "EOS\tx", "EOSx", "a\tb\tc",
    "\t".join(f"t{i}" for i in range(30)) + "\nEOS", "\t".join(["a", "b", "普通名詞", "c", "d", "e", "f"]), "\t" + F29, "a\t" + "," * 28, "a\t" + "," * 27 + '""',
    '"q\t' + F29 + "\nEOS", '"q"\t' + F29.replace("x3", '"x,3"') + "\nEOS", 'a\t"' + F29 + '"', f"a\t{F29}\nEOS\nb\t{F29}", "x\ty\nz",
]


def test_rows_equal_the_array_form(spark):
    """Both forms of the parser on every rule: tokens, rejects, statistics, all levels."""
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(ODD_SENTENCES)], "doc_id long, sent_no int, analysis string").repartition(3)
    corpus, rejects = parse_analyser_output(df)
    rows, rejected = parse_token_rows(sentence_lines(df))
    cols = ["doc_id", "sent_no", "line_no", "raw_line", "reason"]
    assert sorted(rejects.select(*cols).collect()) == sorted(rejected.select(*cols).collect())
    want = {r.doc_id: [tuple(t) for t in r._tok] for r in corpus.df.collect()}
    assert {r.doc_id: [tuple(t)[1:] for t in r._tok] for r in rows.corpus().df.collect()} == want
    stats = {(r.level, r.term): (r.binary, r["count"], r.quote, round(r.pos_index, 9), round(r.pct_index, 9)) for r in rows.statistics().collect()}
    other = {(r.level, r.term): (r.binary, r["count"], r.quote, round(r.pos_index, 9), round(r.pct_index, 9))
             for r in keywords.keyword_stats_levels(corpus, list(range(30))).collect()}
    assert stats == other
    with pytest.raises(Exception):
        parse_token_rows(sentence_lines(df), mode="failfast")[0].df.collect()


def test_rows_plan(spark):
    df = spark.createDataFrame([(0, 0, ODD_SENTENCES[0])], "doc_id long, sent_no int, analysis string")
    rows, _ = parse_token_rows(sentence_lines(df), levels=(1, 2))
    plan = rows.statistics()._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert len(rows.df.columns) == 7


def spelled_out(line):
    """The rules of the module, token by token: (fields, is_eos) or (None, reason)."""
    tab = line.split("\t")
    raw = [tab[0], *tab[1].split(",")] if len(tab) == 2 else tab
    if len(raw) == 30:
        return raw, False
    fixed = raw
    if len(tab) == 2:
        fixed, inside = [tab[0], ""], False
        for ch in tab[1]:
            inside ^= ch == '"'
            if ch == "," and not inside:
                fixed.append("")
            else:
                fixed[-1] += ch
    if line.count('"') % 2:
        return None, "unclosed_quote"
    if len(fixed) == 30:
        return fixed, False
    if fixed[0] == "EOS":
        return ["EOS"] * 30, True
    if len(fixed) == 7 and (fixed[2] in ("数詞", "普通名詞") or fixed[1] == "感動詞"):
        return fixed + [""] * 23, False
    return None, "unknown_type"


def test_lines_of_every_form(spark):
    rnd = random.Random(5)
    bits = ["a", "", "EOS", '"', '"x,y"', "数詞", "感動詞", '"q', "普通名詞x", "b c", "\r", "(", "\\", "$1"]

    def line():
        sep = rnd.choice([",", ",", ",", "\t"])
        n = rnd.choice([1, 2, 6, 6, 6, 7, 28, 29, 29, 29, 30])
        feats = [rnd.choice(["x", "x", "x", rnd.choice(bits)]) for _ in range(n)]
        if n == 6:
            feats[rnd.choice([0, 1])] = rnd.choice(["感動詞", "数詞", "普通名詞"])
        return rnd.choice(["s", "EOS", '"', "", "s\tt"]) + rnd.choice(["\t", "\t", "\t", ""]) + sep.join(feats)

    texts = ["\n".join(["k"] * 0 + ["s\t" + F29] + [line() for _ in range(rnd.choice([1, 1, 2]))] + ["EOS"]) for _ in range(3000)]
    want, bad = {}, {}
    for i, text in enumerate(texts):
        read = [spelled_out(x) for x in text.split("\n")]
        if any(f is None for f, _ in read):
            bad[i] = [(x, "sentence_rejected" if f else why) for x, (f, why) in zip(text.split("\n"), read, strict=True)]
        else:
            want[i] = [(*f, eos) for f, eos in read]
    assert len(want) > 500 and len(bad) > 500
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, analysis string").selectExpr("doc_id", "0 AS sent_no", "analysis")
    corpus, rejects = parse_analyser_output(df)
    assert {r.doc_id: [tuple(t) for t in r._tok] for r in corpus.df.collect()} == want
    assert all(r.n_tokens == len(want[r.doc_id]) for r in corpus.df.collect())
    few, _ = parse_analyser_output(df, levels=(2, 0))
    assert {r.doc_id: [tuple(t) for t in r._tok] for r in few.df.collect()} == {i: [(t[2], t[0], t[30]) for t in ts] for i, ts in want.items()}
    rows, more = parse_token_rows(sentence_lines(df))
    assert {r.doc_id: [tuple(t)[1:] for t in r._tok] for r in rows.corpus().df.collect()} == want
    for got in (rejects, more):
        found = {}
        for r in sorted(got.collect(), key=lambda r: (r.doc_id, r.line_no)):
            found.setdefault(r.doc_id, []).append((r.raw_line, r.reason))
        assert found == bad
    stats = lambda d: {(r.level, r.term): (r.binary, r["count"], round(r.pos_index, 6), round(r.pct_index, 6)) for r in d.collect()}
    assert stats(rows.statistics([0, 1, 2, 29])) == stats(keywords.keyword_stats_levels(corpus, [0, 1, 2, 29]))


def test_long_sentence_is_read_without_recursion(spark):
    text = "\n".join([f's\tA,*,*,*,*,*,"a,b",{",".join("*" * 22)}'] * 30_000 + ["EOS"])
    corpus, rejects = _parse(spark, text)
    assert corpus.df.first().n_tokens == 30_001 and rejects.count() == 0
    _, rejects = _parse(spark, text + '\nx\t"' + '""' * 30_000)
    assert rejects.where("reason = 'unclosed_quote'").count() == 1 and rejects.count() == 30_002
