"""Stored corpus, positional index, split text files, word tables, term vectors, cube cells."""

import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wordlens.functions import wordcodes
from wordlens.functions.tokenise import token_class
from wordlens.operators import align, distance, keywords, positions, reshape
from wordlens.session import scratch_path
from wordlens.sources.corpus import Corpus, build_corpus, read_raw, read_text_corpus, read_text_units
from wordlens.sources.index import build_index, open_index
from wordlens.sources.store import open_corpus, store_corpus, store_table
from wordlens.sources.tokenizers import AnnotatedTokenizer


def formatted(df) -> str:
    """The physical plan as explain("formatted") prints it."""
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


TEXTS = ["the cat, the dog", "a\n\nthe end. the the", "", None, "  \n", "the " * 500 + ".", "one 22 !\nthe cat"]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    return build_corpus(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.fixture(scope="module")
def stored(spark, plain):
    return keywords.store_statistics(store_corpus(plain, scratch_path(spark, "store"), buckets=5))


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rounded = lambda v: round(v, 9) if isinstance(v, float) else [rounded(x) for x in v] if isinstance(v, list) else v
    x, y = (Counter(str(tuple(rounded(r[c]) for c in sorted(a.columns))) for r in df.collect()) for df in (a, b))
    assert x == y and x


def test_store_gives_the_corpus_back(spark, plain, stored):
    again = open_corpus(spark, stored.path, stat_levels=(0,))
    for c in (stored, again):
        same(c.sentences(), plain.sentences())
        same(c.shape(), plain.shape())
        for level in (0, 1):
            same(c.level_form(level), plain.level_form(level))
        same(c.tokens([0, 1]), plain.tokens([0, 1]))
        same(keywords.keyword_report(c, 5), keywords.keyword_report(plain, 5))
        same(keywords.main_element(c, share=0.01), keywords.main_element(plain, share=0.01))
        same(reshape.padded_sentences(c), reshape.padded_sentences(plain))
        same(keywords.keyword_stats(align.recentred_corpus(c, "the")), keywords.keyword_stats(align.recentred_corpus(plain, "the")))
    with pytest.raises(ValueError):
        again.level_array(2)


def test_store_is_read_by_field(stored):
    plan = formatted(reshape.padded_sentences(stored))
    assert plan.count("Scan parquet") // 2 == 1 and "Exchange" not in plan      # tree and details
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<doc_id:bigint,sent_no:int,n_tokens:int,_tok:array<struct<f00:string>>>"]
    report = keywords.keyword_report(stored, 5)
    drill = formatted(keywords.keyword_drilldown(stored, report, rank=1))
    assert drill.count("Scan parquet") // 2 == 1 and "f01" not in drill


def test_bucketed_tables_meet_without_exchange(spark, plain, stored):
    found = store_table(stored, positions.positions_abs(stored, "the").select("doc_id", "sent_no", "positions"), scratch_path(spark, "pos"))
    joined = align.centre_at_positions(stored, found)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # these tables would fit
    try:
        assert "Exchange" not in formatted(joined) and "SortMergeJoin" in formatted(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    same(joined, align.centre_at_word(plain, "the"))


def test_empty_store(spark):
    empty = store_corpus(build_corpus(spark.createDataFrame([], "doc_id long, text string")), scratch_path(spark, "store"), buckets=2)
    assert empty.shape().first()["n_sentences"] == 0 and empty.sentences().count() == 0


# ---- index -----------------------------------------------------------------------

def test_index_answers(spark, plain, stored):
    index = build_index(stored, scratch_path(spark, "index"))
    words = ["the", "EOS", "zzz", ".", "cat"]
    same(index.hits(words), positions.wordlist_abs(plain, words, aligned=False).select("word_no", "term", "doc_id", "sent_no", "n_tokens", "positions"))
    same(index.hits(words, in_percent=True), positions.wordlist_pct(plain, words, aligned=False))
    for word in ("the", "zzz", "EOS"):
        same(index.positions(stored.sentences(), word), positions.positions_abs(plain, word))
        same(index.occurrence(stored.sentences(), word), keywords.word_occurrence(plain, word))
    got, want = index.word_stats("the").first(), keywords.binary_count_quote(plain, "the").first()
    assert (got["binary"], got["count"], got["quote"]) == (want["binary"], want["count"], want["quote"])
    assert index.word_stats("zzz").count() == 0
    report = keywords.keyword_report(stored, 5)
    same(index.drilldown(stored.sentences(), report, 2), keywords.keyword_drilldown(plain, report, rank=2))
    assert index.drilldown(stored.sentences(), report, 999).count() == 0


def test_index_reads_few_row_groups(spark):
    text = F.concat_ws(" ", *[F.concat(F.lit("w"), F.translate(F.hex(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5000))), "0123456789", "ghijklmnop")) for i in range(20)], F.lit("hot"))
    corpus = build_corpus(spark.range(8000).select(F.col("id").alias("doc_id"), text.alias("text")))
    path = scratch_path(spark, "index")
    build_index(corpus, path, slots=24, row_group_bytes=64 << 10)
    files = [pq.ParquetFile(f).metadata for f in Path(path.removeprefix("file:"), "rows").glob("part-*")]
    place = files[0].schema.names.index("term")
    groups = [(f, m.row_group(g).column(place).statistics) for f, m in enumerate(files) for g in range(m.num_row_groups)]
    one = next(s.min for _, s in groups if s.min not in ("EOS", "hot"))
    assert len(groups) > 60
    # a hot term is cut into blocks in several files
    assert len({f for f, s in groups if s.min <= "EOS" <= s.max}) > 4
    # Spark opens the buckets of the word and reads the row groups that may have it
    lookup = open_index(spark, path).rows(one)
    assert lookup.count() == corpus.level_tokens(0).where(F.col("value") == one).select("doc_id", "sent_no").distinct().count()
    lookup.collect()
    assert re.search(r"PushedFilters: .*_slot.*term", formatted(lookup))
    scan = lookup._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    assert scan.metrics().apply("numOutputRows").value() < sum(m.num_rows for m in files) / 6


# ---- text files ------------------------------------------------------------------

def test_text_units_in_splits(spark, tmp_path):
    lines = [f"u{i} x{i}　y{i}" + ("\t" if i % 3 else "") for i in range(3000)]
    lines[5] = lines[6] = ""
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("first second\r\nthird\rfourth", encoding="utf-8")
    (tmp_path / "c.txt").write_text("", encoding="utf-8")
    want = {"a.txt": " ".join(lines).split(), "b.txt": "first second third fourth".split()}
    keys = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    for settings in ({}, keys):
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            units = read_text_units(spark, str(tmp_path))
            got = defaultdict(list)
            for r in units.orderBy("path", "unit_no").collect():
                assert r["unit_no"] == len(got[Path(r["path"]).name])
                got[Path(r["path"]).name].append(r["unit"])
            assert got == want
            corpus = read_text_corpus(spark, str(tmp_path))
            assert corpus.sentences().count() == sum(map(len, want.values()))
        finally:
            for k in settings:
                spark.conf.unset(k)
    assert "wholetext" not in Path("wordlens/sources/corpus.py").read_text()


# ---- word tables, vectors, cells -------------------------------------------------

def test_word_table(spark, plain, monkeypatch):
    words = ["zzz", "the", "EOS", "cat", "22"]
    table = spark.createDataFrame(list(enumerate(words)), "word_no int, term string")
    want = positions.wordlist_abs(plain, words, aligned=False)
    same(positions.wordlist_table(plain, table), want)
    same(positions.wordlist_table(plain, table, in_percent=True), positions.wordlist_pct(plain, words, aligned=False))
    monkeypatch.setattr(keywords, "SMALL_TABLE_ROWS", 2)                       # the salted join
    salted = positions.wordlist_table(plain, table)
    assert "pmod(xxhash64" in formatted(salted)
    same(salted, want)
    assert positions.wordlist_table(plain, table.limit(0)).count() == 0


def test_long_word_table(spark, plain):
    table = spark.range(100_000).select(F.col("id").cast("int").alias("word_no"), F.when(F.col("id") == 70_000, "the").otherwise(F.concat(F.lit("q"), "id")).alias("term"))
    assert positions.wordlist_table(plain, table).count() == positions.wordlist_abs(plain, ["the"], aligned=False).count()


@pytest.mark.parametrize("limit", [200_000, 1])
def test_term_vectors(spark, plain, monkeypatch, limit):
    monkeypatch.setattr(keywords, "SMALL_TABLE_ROWS", limit)
    index = {r["term"]: r["idx"] for r in keywords.vocabulary_index(plain).collect()}
    want = {}
    for r in plain.level_form(0, "t").collect():
        count = Counter(index[x] for x in r["t"])
        want[r["doc_id"], r["sent_no"]] = (sorted(count), [count[i] for i in sorted(count)])
    got = {(r["doc_id"], r["sent_no"]): (r["indices"], r["counts"]) for r in keywords.term_vectors(plain).collect()}
    assert got == want
    assert {r["n_terms"] for r in keywords.term_vectors(plain).collect()} == {len(index)}


def test_distance_cells(spark):
    corpus = build_corpus(spark.createDataFrame([(0, "a b a c b a b"), (1, "c"), (2, "a " * 9 + "b " * 8), (3, " ".join(["a b c"] * 4000))], "doc_id long, text string"))
    words = ["a", "b", "x", "c"]
    whole = distance.distance(corpus.with_df(corpus.df.where("doc_id < 3")), words, expand=True)
    cells = distance.distance_cells(corpus.with_df(corpus.df.where("doc_id < 3")), words, 0, 10 ** 6).drop("combinations")
    same(cells, whole)
    part = distance.distance_cells(corpus.with_df(corpus.df.where("doc_id < 3")), words, 5, 11).drop("combinations")
    same(part, whole.where("c >= 5 and c < 11"))
    # far inside a cube of 6.4e10 cells a pair: nothing before it is made
    far = distance.distance_cells(corpus, words, 6 * 10 ** 10, 6 * 10 ** 10 + 3).collect()
    assert {r["combinations"] for r in far} == {str(4000 ** 3)} and len(far) == 3 * 16
    p = {w: [3 * k + i for k in range(4000)] for i, w in enumerate("abc")} | {"x": [1000]}
    assert all(r["distance"] == p[r["term_i"]][0] - p[r["term_j"]][r["c"] % len(p[r["term_j"]])] for r in far)


def test_salted_words_never_pass_through_the_driver(spark):
    """Spark takes the salted table for as small as the one it is made of and would broadcast it."""
    rows = spark.createDataFrame([(i, f"w{i % 7}") for i in range(50)], "doc_id long, term string")
    words = spark.range(7).select(F.concat(F.lit("w"), "id").alias("term"), F.col("id").alias("idx"))
    got = keywords.salted_join(rows, words, "term", keywords.SMALL_TABLE_ROWS + 1, ["doc_id"])
    assert sorted((r["doc_id"], r["idx"]) for r in got.collect()) == [(i, i % 7) for i in range(50)]
    assert "Broadcast" not in formatted(got)


def test_index_lookup_and_slots(spark):
    texts = spark.range(0, 40, 1, 20).select(F.col("id").alias("doc_id"), F.concat(F.lit("the cat w"), "id").alias("text"))
    corpus = build_corpus(texts)
    index = build_index(corpus, scratch_path(spark, "index"))
    assert index.slots == 20 * 16                       # more splits, more slots of the same size
    hits = index.hits(["the", "cat", "the"])
    assert hits.count() == 120 and " Exchange" not in formatted(hits)   # hot words stay where they are


def test_distance_cells_look_at_the_tokens_once(spark):
    corpus = build_corpus(spark.createDataFrame([(0, "a b a c b a b")], "doc_id long, text string"))
    plan = formatted(distance.distance_cells(corpus, ["a", "b", "x"], 1, 4))
    assert plan.count("transform(_t") == 1 and "transform(_tok" not in plan


def test_text_is_dealt_and_tokenised_on_the_way_into_the_files(spark, plain, stored):
    """what travels to the buckets is the text; the files hold the order it was sorted in."""
    assert plain.raw.columns == ["doc_id", "sent_no", "text"]
    same(read_raw(plain.raw, plain.keys, plain.tokenizer), plain.df)
    files = sorted(Path(stored.path, "tokens").glob("*.parquet"))
    assert len(files) == len({re.search(r"_(\d{5})", f.name).group(1) for f in files}) <= 5    # one a bucket
    for f in files:
        keys = list(zip(*(pq.read_table(f).column(k).to_pylist() for k in plain.keys), strict=True))
        assert keys == sorted(keys)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    again = store_corpus(plain.with_df(plain.df), scratch_path(spark, "tokens"), buckets=3)     # a corpus without its text
    same(again.level_form(1), plain.level_form(1))


def test_classes_by_bytes_are_those_of_the_pattern(spark):
    chars = spark.createDataFrame([(chr(i),) for i in range(1, 0x3100)], "c string")
    want = F.when(F.col("c").rlike(r"^\p{L}"), "WORD").when(F.col("c").rlike(r"^\p{N}"), "NUM").otherwise("PUNCT")
    for tail in ("", "z", "é"):
        rows = chars.select(F.concat("c", F.lit(tail)).alias("c"))
        assert rows.count() == 0x30ff and rows.where(token_class(F.col("c")) != want).count() == 0


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_disk_of_term_vectors(spark, plain, monkeypatch):
    """Cells do not travel with their words, and what travelled is gone when its table is written."""
    monkeypatch.setattr(keywords, "SMALL_TABLE_ROWS", 1)
    before = shuffle_files(spark)
    stored = store_corpus(plain, scratch_path(spark, "store"), buckets=3)
    vectors = keywords.term_vectors(stored)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:   # they are removed in the background
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    plan = formatted(vectors)
    travels = re.findall(r"\) Exchange\n(?:Input|Output) *\[\d+\]: \[(.*)\]", plan)
    assert len(travels) == 1 and "term" not in travels[0] and "_codes" not in travels[0]
    words = keywords.coded_sentences(stored)[1]
    assert words.count() == words.select("_group", "term").distinct().count()


@pytest.mark.parametrize("cells, n_words", [(1, 10 ** 6), (10 ** 6, 3), (10 ** 6, 10 ** 6)])
def test_term_vectors_across_groups(spark, monkeypatch, cells, n_words):
    """Groups and slices of a few tokens; NULL is no word, other keys, a vocabulary that lacks words."""
    for name, value in (("GROUP_CELLS", cells), ("GROUP_WORDS", n_words), ("SLICE_TOKENS", 5), ("WORDS_A_ROW", 2)):
        monkeypatch.setattr(wordcodes, name, value)
    texts = [["b", None, "a", "b"], [], [None, None], ["c"] * 400, [f"w{i % 17}" for i in range(300)], ["d", "a", "\U0001f600", "\uffff", ""], None] * 3
    rows = [(f"k{i}", i % 4, t and [(x, False) for x in t] if t is not None else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "path string, sent_no int, _tok array<struct<f00 string, is_eos boolean>>").repartition(2)
    corpus = Corpus(df.withColumn("n_tokens", F.size("_tok")), ("path", "sent_no"), AnnotatedTokenizer())

    def want(index):
        count = {(k, n): Counter(index[x] for x, _ in t or [] if x in index) for k, n, t in rows}
        return {k: (sorted(c), [c[i] for i in sorted(c)]) for k, c in count.items() if c}

    def got(vectors):
        return {(r["path"], r["sent_no"]): (r["indices"], r["counts"]) for r in vectors.collect()}

    words = sorted({x for t in texts for x in t or [] if x is not None}, key=lambda x: x.encode())
    index = {x: i for i, x in enumerate(words)}
    vectors = keywords.term_vectors(corpus)
    assert got(vectors) == want(index) and {r["n_terms"] for r in vectors.select("n_terms").collect()} == {len(index)}
    some = {"a": 7, "w3": 5, "c": 2 ** 40}
    own = spark.createDataFrame(list(some.items()), "term string, idx long")
    assert got(keywords.term_vectors(corpus, vocabulary=own)) == want(some)
    assert got(keywords.term_vectors(corpus, vocabulary=own.where("term = 'none'"))) == {}


def test_many_words_in_a_bucket(spark):
    """The words of a bucket are written once, also where they pass a megabyte."""
    word = lambda i: F.substring(F.translate(F.sha2((F.col("id") * 100 + i % 100).cast("string"), 256), "0123456789", "ghijklmnop"), 1, 12)
    texts = spark.range(1500).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(299)), word), " ").alias("text"))
    stored = store_corpus(build_corpus(texts), scratch_path(spark, "store"), buckets=1)
    for file in Path(stored.path.removeprefix("file:")).glob("tokens/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}["_tok.list.element.f00"]
        assert "PLAIN" not in column.encodings and column.total_uncompressed_size > 1 << 20
