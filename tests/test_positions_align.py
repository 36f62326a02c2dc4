# The expected positions, cuts and slot counts of the nine sentences below are results that must match.
from pyspark.sql import functions as F

from wordlens.operators import align, positions, project
from tests.conftest import by_doc

WORDS = ["ばかり", "なく", "で", "は", "、", "。"]
EXPECTED = [
    [[4], [9], [9], [6], [12], [26], [9], [10], [10]],
    [[6], [12], [11], [8], [14], [], [11], [12], [12]],
    [[5], [10], [10], [7], [10, 13, 23], [34], [7, 10, 33], [11], [11, 15]],
    [[2], [11], [1], [1], [3], [1], [1], [], [2, 7]],
    [[7], [6, 13], [2, 12], [9, 16], [4, 15], [2, 17, 28, 35], [12, 28], [13], [8, 13]],
    [[18], [18], [24], [22], [28], [45], [35], [30], [23]],
]


def test_positions_abs(nine):
    assert by_doc(positions.positions_abs(nine, "ばかり").collect(), "positions") == EXPECTED[0]


def test_wordlist_abs(nine):
    rows = positions.wordlist_abs(nine, WORDS).collect()
    got = [[r.positions for r in sorted((r for r in rows if r.word_no == i), key=lambda r: r.doc_id)]
           for i in range(len(WORDS))]
    assert got == EXPECTED


def test_positions_pct(nine):
    eos = positions.positions_pct(nine, "EOS").collect()
    assert all(r.positions == [100.0] for r in eos)
    bak = positions.positions_pct(nine, "ばかり").collect()
    assert all(len(r.positions) == 1 and 0 < r.positions[0] < 100 for r in bak)
    assert max(len(r.positions) for r in positions.positions_pct(nine, "で").collect()) == 3
    assert max(len(r.positions) for r in positions.positions_pct(nine, "、").collect()) == 4
    wl = positions.wordlist_pct(nine, WORDS).where("word_no = 0").collect()
    assert by_doc(wl, "positions") == by_doc(bak, "positions")


def _centre_rows(df):
    return by_doc(df.collect(), "l0")


def test_centre_at_positions(nine, spark):
    pos = spark.createDataFrame([(i, 0, [1]) for i in range(9)], "doc_id long, sent_no int, positions array<int>")
    suffix = _centre_rows(align.centre_at_positions(nine, pos, 1))
    assert [s[0] for s in suffix] == ["に", "はたん", "は", "は", "天", "は", "は", "軍", "さん"]
    prefix = _centre_rows(align.centre_at_positions(nine, pos, 0))
    assert all(len(s) == 2 for s in prefix) and prefix[0][1] == "に" and prefix[-1][1] == "さん"
    rev = _centre_rows(align.centre_at_positions(nine, pos, -1))
    assert all(len(s) == 2 for s in rev) and rev[1][0] == "はたん"
    none = spark.createDataFrame([(i, 0, []) for i in range(9)], "doc_id long, sent_no int, positions array<int>")
    assert all(s == [] for s in _centre_rows(align.centre_at_positions(nine, none, 1)))
    missing = pos.where("doc_id < 3")
    assert sum(1 for s in _centre_rows(align.centre_at_positions(nine, missing, 1)) if s) == 3


def test_centre_duplicate_keys_raise(nine, spark):
    import pytest
    dup = spark.createDataFrame([(0, 0, [1]), (0, 0, [2])], "doc_id long, sent_no int, positions array<int>")
    with pytest.raises(Exception):
        align.centre_at_positions(nine, dup, 1).collect()


def test_sub_sentence_after_reverse(nine):
    rev = align.centre_at_position(nine, 2, -1)
    sub = project.sub_sentence(rev, "l0", 1, 3)
    rows = _centre_rows(sub)
    assert all(len(s) == 2 for s in rows)
    assert rows[0][0] == "に" and rows[1][0] == "はたん" and rows[-1][0] == "さん" and rows[-1][-1] == "ピーター"
    assert all(len(s) == 2 for s in _centre_rows(project.sub_sentence(rev, "l0", 1, 1000)))


def test_centre_word_and_slots(nine):
    cw = align.centre_word(nine, "ばかり")
    rows = _centre_rows(cw)
    assert [len(s) for s in rows] == [16, 11, 17, 18, 18, 21, 28, 22, 15]
    assert all(s[0] == "ばかり" and s[1] in ("で", "か") for s in rows)
    freq = align.slot_frequency(cw, list(nine.keys), [0])
    got = {}
    for r in freq.collect():
        got.setdefault(r.rel_pos, {})[r.value] = r.n
    assert len(got) == 28
    assert all(sum(v.values()) == 9 for v in got.values())
    assert got[0] == {"ばかり": 9}
    assert got[1] == {"で": 8, "か": 1}
    assert got[2] == {"なく": 7, "は": 1, "、": 1}
    assert got[3] == {"、": 7, "なく": 1, "驚く": 1}
    assert len(got[4]) == 9
    assert got[27] == {"EOS": 1, None: 8}


def test_recentred_corpus(nine):
    rc = align.recentred_corpus(nine, "ばかり")
    assert by_doc(rc.sentences().collect(), "n_tokens") == [16, 11, 17, 18, 18, 21, 28, 22, 15]
    none = align.recentred_corpus(nine, "unknown")
    assert none.df.count() == 9 and all(r.n_tokens == 0 for r in none.sentences().collect())


def test_slot_values_and_counts(nine):
    sv = align.slot_values(align.centre_word(nine, "ばかり"), list(nine.keys), [0])
    assert sv.count() == 16 + 11 + 17 + 18 + 18 + 21 + 28 + 22 + 15
    ec = {r.value: r.n for r in align.element_counts(sv.where("rel_pos = 1"), "value").collect()}
    assert ec == {"で": 8, "か": 1}


def test_level_projections(nine):
    assert project.level_values(nine, 0).count() == 261 - 9
    win = project.level_window(nine, 0, 200)
    assert len(win.columns) == 3 + 30
    lps = project.level_per_sentence(nine, 0).where("doc_id = 0").first()
    assert lps["values"][0] == "これ" and lps["values"][-1] == "EOS"
    trimmed = project.trim_sentence_to_length(nine.level_form(0, "t"), "t", 60).collect()
    assert all(len(r.t) == 60 and r.t[-1] == "EOS" for r in trimmed)
    cut = project.trim_sentence_to_length(nine.level_form(0, "t"), "t", 10).collect()
    assert all(len(r.t) == 10 for r in cut)
    mapped = project.map_values(nine.level_form(0, "t"), ["t"], lambda x: F.length(x), depth=1)
    assert mapped.where("doc_id = 0").first().t[0] == 2
