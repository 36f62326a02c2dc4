"""Toxicity, clustering and the Merkle manifest: brute force, held-out accuracy, odd rows."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordlens.llm import clusters, line_dedup, merkle, quality, queries, simhash, toxicity
from wordlens.llm.common import recorded, release, scratch

WORDS = "the of and lyan onst thering ea inwh hation erenti blest ouen ndst wher anth tiore".split()
INSULTS = "idiot worthless moron pathetic".split()


def local(df):
    return [r.asDict() for r in df.collect()]


# ---- Merkle ----------------------------------------------------------------------

def plain_manifest(rows, fanout=3):
    """The contract, row by row: list of (doc_id, leaf, subroot, root, proof, folded, verified)."""
    def h(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(r, text):
        return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])

    def tree(level):
        """(root, for every leaf the siblings before and after, level by level)"""
        at, ways = list(range(len(level))), [[] for _ in level]
        while len(level) > 1:
            for i, way in enumerate(ways):
                a = at[i] - at[i] % fanout
                way.append((level[a:at[i]], level[at[i] + 1:a + fanout]))
                at[i] //= fanout
            level = [h(level[a:a + fanout]) for a in range(0, len(level), fanout)]
        return level[0], ways

    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = tree([leaf(r, r["text"]) for r in by[s]])
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for r, way in zip(by[s], trees[s][1], strict=True):
            text, whole = r["text"], way + top
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for before, after in whole:
                folded = h([*before, folded, *after])
            out.append((r["doc_id"], leaf(r, r["text"]), trees[s][0], root, h([d for b, a in whole for d in [*b, *a]]), folded, folded == root))
    return out


def test_addresses():
    for levels in range(1, 9):
        places = np.concatenate([merkle.address(d, np.arange(3 ** d), levels) for d in range(levels)])
        assert sorted(places.tolist()) == list(range(merkle.nodes(levels)))
    # four levels are cut into two and two: the root's subtree, then nine subtrees of four nodes
    assert merkle.address(2, np.arange(9), 4).tolist() == [4 * (1 + i) for i in range(9)]
    assert merkle.address(3, np.arange(27), 4).tolist() == [4 + 4 * (i // 3) + 1 + i % 3 for i in range(27)]


@pytest.mark.parametrize("levels", [3, 4])
def test_manifest(spark, levels):
    """Against the contract, with small blocks so that trees have many and blocks lie in layers."""
    rng = np.random.default_rng(3)
    rows = [(i, f"a{i}\nb" if i % 5 else None, ["en", None][i % 2], ["hot", "é", "zz", None, "", f"s{i}"][min(int(rng.integers(12)), 5) if i > 100 else 0], i) for i in range(250)]
    rows += [rows[3], rows[3], (None, "x\ny", None, "hot", None), (3, "other", "en", "hot", 2 ** 60 + 1), (2 ** 62 + 1, "z\n", "en", "hot", None), (7, "w" * 50000 + "\n", "en", "", 1)]
    docs = scratch(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _n string, _tree int"), "docs")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r[c] for c in names) for r in local(merkle.manifest(docs, levels))]
    want = plain_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_small(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0
    one = local(merkle.manifest(spark.createDataFrame([(1, None, None, None, None)], schema)))
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_large_blocks(spark):
    """More rows of one source than a block holds."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t\n"), "id").alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") % 50 == 0, F.concat(F.lit("s"), "id")).otherwise("hot").alias("source"), F.col("id").alias("n_chars"))
    rows = local(docs)
    got = {r["doc_id"]: r for r in local(merkle.manifest(docs))}
    for want in plain_manifest(rows):
        assert tuple(got[want[0]].values()) == want


# ---- clusters --------------------------------------------------------------------

def plain_clusters(rows, k, rounds, scale, width):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in v] for _, v in kept]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, hashlib.sha256(f"1:{kept[j][0]}".encode()).hexdigest(), kept[j][1]))
    centroids = [ints[j] for j in order[:k]]

    def assign():
        out = []
        for v in ints:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [v for v, (own, _) in zip(ints, found, strict=True) if own == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assign()
    fit = lambda x: x if x <= 2 ** 63 - 1 else None
    per = defaultdict(int)
    for c, d in found:
        per[c] += d
    return [(kept[j][0], c, fit(d), fit(per[c]), fit(sum(per.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for j, (c, d) in enumerate(found)]


@pytest.mark.parametrize("large", [0, 1e5, 3e9, 1e30])
def test_clusters(spark, large):
    rng = np.random.default_rng(5)
    width, k = 6, 5
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=width) * rng.choice([0.2, 1, 3]), 2)]) for i in range(200)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (900, None), (901, [1.0] * 5), (902, [1.0] * 5 + [None]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, []),
             (906, [0.0] * 6), (907, [-0.0] * 6), (908, [-1e-9] * 6)]
    if large:
        rows += [(1000 + i, [float(large * x) for x in rng.integers(-3, 4, width)]) for i in range(40)]
    df = scratch(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cluster int"), "vectors")
    got = [tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in
           local(clusters.cluster(df, k=k, rounds=3, scale=64, width=width))]
    want = plain_clusters(rows, k, 3, 64, width)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    if large == 1e30:                       # more than 38 digits: no distance, the rest holds
        assert {(r[0], r[1], r[5]) for r in got} == {(r[0], r[1], r[5]) for r in want}
    assert sorted(got, key=key) == sorted(want, key=key)


def test_clusters_small(spark):
    schema = "vec_id long, embedding array<float>"
    assert clusters.cluster(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([(i, [float(i)] * 64) for i in range(3)], schema)
    assert sorted(r["cluster"] for r in local(clusters.cluster(few))) == [0, 1, 2]


def test_products_only_move_by_changes():
    rng = np.random.default_rng(1)
    v, old = rng.integers(-99, 99, (50, 8)), rng.integers(-99, 99, (4, 8))
    new = old.copy()
    new[1, 3] += 7
    new[2] = rng.integers(-99, 99, 8)
    assert (clusters.moved(v, v @ old.T, old, new) == v @ new.T).all()


def test_op12_query(spark):
    from wordlens.session import read_table
    rows = [(r["vec_id"], None if r["embedding"] is None else list(r["embedding"])) for r in local(read_table(spark, "/root/testdata/sf0.001", "embeddings"))]
    got = [tuple(r.values()) for r in local(queries.op12_centroid_clusters(spark, "/root/testdata/sf0.001"))]
    assert sorted(got) == sorted(plain_clusters(rows, 16, 3, 64, 64))


# ---- toxicity --------------------------------------------------------------------

@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(11)
    rows, labels = [], []
    for i in range(900):
        words = [a + b for a, b in zip(rng.choice(WORDS, 120), rng.choice(WORDS, 120), strict=True)]
        toxic = int(i % 6 == 0)
        if toxic:
            for at in rng.integers(0, 120, 6):
                words.insert(int(at), str(rng.choice(INSULTS)))
        rows.append((i, " ".join(words).capitalize(), "en", "src"))
        if i % 2 == 0 or toxic:
            labels.append((i, 1, toxic))
    rows += [rows[0], rows[0], (None, "You idiot", None, None), (5000, None, "en", None), (5001, "", "en", None), (5002, " \n ", "en", None),
             (5003, "x" * 5000, "en", None), (5004, rows[6][1] + " " + " ".join([rows[1][1]] * 300), "en", None), (5005, rows[1][1] * 1000, "en", None)]
    labels += [(None, 1, 1), (7, None, None), (0, 1, 1), (99999, 1, 1)]
    docs = scratch(spark.createDataFrame([(*r, 0.5, True) for r in rows], "doc_id long, text string, lang string, source string, score double, held_out boolean"), "docs")
    return docs, scratch(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")


def test_toxicity(spark, labelled):
    docs, labels = labelled
    got = local(toxicity.toxicity(docs, labels))
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert {r["doc_id"] for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r["predicted"] == int(r["doc_id"] % 6 == 0) for r in held]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert not by[None]["held_out"] and by[5000]["score"] == by[5001]["score"] == by[5002]["score"]
    assert not {i: r for i, r in by.items() if i in (5000, 5001, 5002, 5003, 5005) and r["predicted"]}
    assert len({r["score"] for r in got if r["doc_id"] == 0}) == 1          # repeated rows
    # held-out labels are not learnt from
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in local(toxicity.toxicity(docs, flipped))}
    assert again == {r["doc_id"]: r["score"] for r in got}


def test_toxicity_without_examples(spark, labelled):
    docs, labels = labelled
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        got = local(toxicity.toxicity(docs, some))
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_windows_cover_whole_texts():
    rng = np.random.default_rng(2)
    text = " ".join(str(x) for x in rng.integers(0, 10 ** 6, 120_000)) + "\n　ÄÖ " + "y" * 700
    whole = b"".join(toxicity.windows(text)).split()
    want = text.lower().encode().split()
    assert whole[:-3] == want[:-1] and b"".join(whole[-3:]) == want[-1]
    assert list(toxicity.windows(None)) == [] == list(toxicity.windows(" \n"))


# ---- filtering operators keep other columns as they are ---------------------------

@pytest.mark.parametrize("stage", [quality.clean, line_dedup.dedup_lines, simhash.first_of_groups])
def test_columns_come_back_as_they_were(spark, stage):
    """Columns named like working columns, and an ``n_chars`` of another integer type."""
    text = "\n".join(" ".join(["different", *(f"{x:x}" for x in np.random.default_rng(i).integers(0, 10 ** 6, 9))]) for i in range(12))
    rows = [(i, text.replace("different", f"w{i % 3}x"), "en", "src", len(text), 100 + i, f"r{i}", [i], i / 2, True) for i in range(6)]
    own = "_rid long, removed string, _kept array<int>, _gone double, _row boolean"
    docs = scratch(spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars int, {own}"), "docs")
    out = stage(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = local(out)
    assert got
    for r in got:
        i = r["doc_id"]
        assert (r["_rid"], r["removed"], r["_kept"], r["_gone"], r["_row"]) == (100 + i, f"r{i}", [i], i / 2, True)


def test_release(spark, tmp_path):
    with recorded() as paths:
        kept = scratch(spark.range(5), "kept")
    assert len(paths) == 1 and kept.count() == 5
    release(spark, paths)
    assert paths == [] and not list(__import__("pathlib").Path(kept._scratch_path.removeprefix("file:")).glob("part-*"))
