# The expected distances and transposes of the nine sentences below are results that must match.
import pytest
from pyspark.sql import functions as F

from wordlens.functions.arrays import map_values, ragged_transpose
from wordlens.operators import distance, reshape
from wordlens.sources.corpus import build_corpus
from wordlens.sources.tokenizers import PresegmentedTokenizer

WORDS = ["ばかり", "なく", "で", "は", "、", "。"]
SENT3 = [
    [[0, 0], [-2, -2], [-1, -1], [5, 5], [-3, -10], [-16, -16]],
    [[2, 2], [0, 0], [1, 1], [7, 7], [-1, -8], [-14, -14]],
    [[1, 1], [-1, -1], [0, 0], [6, 6], [-2, -9], [-15, -15]],
    [[-5, -5], [-7, -7], [-6, -6], [0, 0], [-8, -15], [-21, -21]],
    [[3, 3], [1, 1], [2, 2], [8, 8], [0, -7], [-13, -13]],
    [[16, 16], [14, 14], [15, 15], [21, 21], [13, 6], [0, 0]],
]


def _cube(rows, n_words):
    cube = [[[] for _ in range(n_words)] for _ in range(n_words)]
    for r in sorted(rows, key=lambda r: r.c):
        cube[r.i][r.j].append(r.distance)
    return cube


def test_distance_sentence_3(nine):
    rows = distance.distance(nine, WORDS, expand=True).where("doc_id = 3").collect()
    assert _cube(rows, 6) == SENT3


def test_distance_combination_counts(nine):
    full = distance.distance(nine, WORDS, expand=True)
    assert full.count() == 1152
    per = {r.doc_id: r.n for r in full.groupBy("doc_id").agg((F.count(F.lit(1)) / 36).alias("n")).collect()}
    assert [int(per[i]) for i in range(9)] == [1, 2, 2, 2, 6, 4, 6, 1, 8]
    compact = distance.distance(nine, WORDS)
    product = F.aggregate("sizes", F.lit(1), lambda acc, n: acc * n)
    assert compact.agg(F.sum((product / F.col("n_j")).cast("long"))).first()[0] == 1152


def test_distance_long_word_list(spark):
    """25 words, 40 hits each: the combinations exceed every number type, the rows do not."""
    words = [f"w{i}" for i in range(25)]
    df = spark.createDataFrame([(1, " ".join(words * 40))], "doc_id long, text string")
    corpus = build_corpus(df, tokenizer=PresegmentedTokenizer())
    rows = distance.distance(corpus, words).collect()
    assert len(rows) == 25 * 25 * 40 and all(r.n_j == 40 and r.sizes == [40] * 25 for r in rows)
    assert all(r.distance == r.i - (r.j + 25 * r.k) for r in rows)
    with pytest.raises(Exception, match="too many combinations"):
        distance.distance(corpus, words, expand=True).count()


def test_distance_absent_word(nine):
    rows = distance.distance(nine, WORDS + ["X"], expand=True).where("doc_id = 3").collect()
    cube = _cube(rows, 7)
    assert cube[0][6] == [-994, -994] and cube[6][0] == [994, 994]
    assert cube[6][4] == [991, 984] and cube[6][6] == [0, 0]


def test_ragged_transpose_cases(spark):
    cases = [
        ([[1, 2, 3], [4, 5, 6]], None, [[1, 4], [2, 5], [3, 6]]),
        ([[1, 2, 3], [4, 5]], None, [[1, 4], [2, 5], [3, None]]),
        ([[1, 2, 3], [4, 5]], 10, [[1, 4], [2, 5], [3, 10]]),
        ([[1, 2], [4, 5, 6]], None, [[1, 4], [2, 5], [None, 6]]),
        ([[1, 2]], None, [[1], [2]]),
        ([[]], None, []),
        ([], None, []),
    ]
    for m, ph, expected in cases:
        df = spark.createDataFrame([(m,)], "m array<array<int>>")
        col = ragged_transpose(F.col("m"), None if ph is None else F.lit(ph))
        assert df.select(col.alias("t")).first().t == expected


def test_ragged_transpose_rejects_flat(spark):
    import pytest
    df = spark.createDataFrame([([1, 2],)], "m array<int>")
    with pytest.raises(Exception):
        df.select(ragged_transpose(F.col("m")).alias("t")).collect()


def test_map_values_nested(spark):
    df = spark.createDataFrame([([[1, 10], [2], []],), ([],)], "m array<array<int>>")
    out = df.select(map_values("m", lambda x: x * 2, depth=2).alias("m")).collect()
    assert [r.m for r in out] == [[[2, 20], [4], []], []]


def test_padded_and_axes(nine):
    padded = reshape.padded_sentences(nine, width=47).collect()
    assert len(padded) == 9 and all(len(r.padded) == 47 and r.padded[-1] == "EOS" for r in padded)
    runs = {r.doc_id: r for r in reshape.padded_sentences(nine).collect()}
    assert all(runs[r.doc_id]["values"] + [runs[r.doc_id].pad_value] * runs[r.doc_id].pad_count == r.padded for r in padded)
    long = reshape.axes_moved(nine, levels=list(range(30)))
    assert long.count() == 47 * 30 * 9
    counts = reshape.axes_moved_counts(nine, [0, 1])
    per_slot = counts.groupBy("pos", "level").agg(F.sum("n").alias("s")).collect()
    assert len(per_slot) == 47 * 2 and all(r.s == 9 for r in per_slot)
    slot1 = {r.value: r.n for r in counts.where("pos = 1 and level = 0").collect()}
    assert sum(slot1.values()) == 9
    from_long = {r.value: r["count"] for r in long.where("pos = 1 and level = 0").groupBy("value").count().collect()}
    assert from_long == slot1


def test_rotated_sentence(nine):
    rows = reshape.rotated_sentence(nine, [0, 1]).where("doc_id = 0").orderBy("level").collect()
    assert rows[0]["values"][0] == "EOS" and rows[0]["values"][1] == "。" and rows[0]["values"][-1] == "これ"
    assert rows[1]["values"][0] == "EOS"


def test_intervals_equal_the_padded_axes(spark):
    import random
    from collections import Counter

    from wordlens.operators import reshape
    from wordlens.sources.corpus import build_corpus

    rng = random.Random(5)
    texts = ["\n".join(" ".join(rng.choice(["a", "a", "b", "7", "."]) for _ in range(rng.randint(0, 12))) for _ in range(4)) for _ in range(30)]
    c = build_corpus(spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string"))
    rows = reshape.axes_moved_intervals(c, [0, 1])
    spread = Counter()
    for r in rows.collect():
        for pos in range(r["start"], r["stop"]):
            spread[pos, r["level"], r["doc_id"], r["sent_no"], r["value"]] += 1
    want = Counter((r["pos"], r["level"], r["doc_id"], r["sent_no"], r["value"]) for r in reshape.axes_moved(c, [0, 1]).collect())
    assert spread == want
    counted = {}
    for r in reshape.interval_counts(rows).collect():
        counted |= {(pos, r["level"], r["value"]): r["n"] for pos in range(r["start"], r["stop"])}
    assert counted == {(r["pos"], r["level"], r["value"]): r["n"] for r in reshape.axes_moved_counts(c, [0, 1]).collect()}
    at = {(r["level"], r["doc_id"], r["sent_no"]): r["value"] for r in reshape.slot(rows, 9).collect()}
    assert at == {k[1:4]: k[4] for k in want if k[0] == 9}
    assert reshape.axes_moved_intervals(c.with_df(c.df.limit(0)), [0]).count() == 0


def test_interval_plan_reads_the_texts_once_and_pads_no_rows(spark):
    from wordlens.operators import reshape
    from wordlens.sources.corpus import build_corpus

    long = "x " * 5000
    c = build_corpus(spark.createDataFrame([(i, "a b" if i else long) for i in range(200)], "doc_id long, text string"))
    rows = reshape.axes_moved_intervals(c, [0])
    assert rows.count() == 199 * 3 + 2            # a run of 5000 equal tokens is one row
    assert rows.agg({"stop": "max"}).first()[0] == 5001
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan       # what is read again is the written table


def test_interval_counts_count_equal_intervals_before_the_steps(spark):
    """the generator that doubles rows stands behind the first aggregation, and the steps travel once."""
    import re

    from wordlens.operators import reshape

    rows = spark.createDataFrame([(0, "x", 0, 1)] * 50 + [(0, "x", 1, 2)] * 50 + [(0, "x", 2, 9), (0, None, 0, 3), (0, None, 0, 3), (1, "x", 0, 1)],
                                 "level int, value string, start int, stop int")
    counted = reshape.interval_counts(rows)
    assert sorted(counted.collect(), key=str) == sorted([(0, 0, 2, "x", 50), (0, 2, 9, "x", 1), (0, 0, 3, None, 2), (1, 0, 1, "x", 1)], key=str)
    jvm = spark._jvm
    plan = counted._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert [len(re.findall(r"#", d)) for d in dealt[:2]] == [2, 4], plan
