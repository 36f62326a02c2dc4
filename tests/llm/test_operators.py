"""Each operator against brute force, the library or an exact round trip, on small tables
with null, empty, long and repeated texts, empty tables and clashing column names."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordlens.llm import ann, bpe, line_dedup, packing, quality, queries, rans, secret_scan, sharding, simhash, warc
from wordlens.llm.common import scratch, scratch_path
from wordlens.llm.components import components, local_roots
from wordlens.llm.tokens import ChunkEncoder

ODD = ["", "ΑΣ Σ. A\x1cb \x1f", "x<|endoftext|>y <|EndOfText|> <|startoftext|><|endoftext|>", "\0<|endoftext|>",
       "don't it's, it's. I'LL", "é ́a 東京 12,3 3.5. a.,b...", "İstanbul ŞŒ x​y\xa0z", "a" * 3001, "aaaa aaaaa    aaa",
       "  \n\n  x \t", "naïve.. a.'s Éa. É.", "😀 ﬁ ß ǅ ²³", "ab" * 900]
WORDS = "the of and lyan onst thering ea inwh hation erenti blest ouen ndst wher anth tiore".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS, n)) + f" {rng.integers(10 ** 6):x}"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(7)
    base = ["\n".join(sentence(rng, int(rng.integers(6, 30))) for _ in range(int(rng.integers(1, 6)))) for _ in range(60)]
    texts = base + base[:8] + [t.replace(" of ", " a ", 1) for t in base[:20]] + [None, "", "one", base[0] + "\n" + base[1], " ".join(base) * 5]
    rows = [(i, t, "en", f"src{i % 2}" if i % 9 else None, len(t or ""), "other") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[5], None, None, None, None)]
    return scratch(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string"), "docs")


@pytest.fixture(scope="module")
def none(spark, docs):
    return scratch(docs.limit(0), "none")


def local(df):
    return [r.asDict() for r in df.collect()]


# ---- tokens ----------------------------------------------------------------------

@pytest.mark.parametrize("make, path", [(ChunkEncoder, queries.WORD_TOKENIZER), (bpe.ByteBPE, queries.BYTE_TOKENIZER)])
def test_ids_equal_the_library(make, path):
    library, own = Tokenizer.from_file(path), make(path)
    ids, counts = own.encode(ODD + ODD)
    ends = np.cumsum(counts)
    for i, text in enumerate(ODD + ODD):
        assert ids[ends[i] - counts[i]:ends[i]].tolist() == library.encode(text, add_special_tokens=False).ids
    if make is bpe.ByteBPE:
        assert own.decode(ids, counts) == ODD + ODD


def test_codec_frame(spark, docs, none):
    got = local(bpe.encode_decode(docs, queries.BYTE_TOKENIZER))
    texts = Counter((r["doc_id"], r["text"] or "") for r in local(docs))
    assert Counter((r["doc_id"], r["decoded"]) for r in got) == texts
    assert bpe.encode_decode(none, queries.BYTE_TOKENIZER).count() == 0


# ---- packing ---------------------------------------------------------------------

def check_packed(rows, capacity):
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    assert max(at.values(), default=0) <= capacity
    return len(at)


def test_packing_documents(spark, docs, none):
    pieces = packing.token_pieces(docs, queries.WORD_TOKENIZER, capacity=256)
    got = local(packing.pack(pieces, capacity=256, block_rows=40))
    least = -(-sum(r["length"] for r in got) // 256)
    assert check_packed(got, 256) <= 1.1 * least + 1
    library, whole = Tokenizer.from_file(queries.WORD_TOKENIZER), {}
    for r in local(docs):
        whole[r["doc_id"]] = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
    for r in got:
        ids = np.array(whole[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in got) == sum(len(whole[r["doc_id"]]) for r in local(docs))
    assert packing.pack(packing.token_pieces(none, queries.WORD_TOKENIZER)).count() == 0


def test_packing_any_rows(spark):
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(int(x), 9) for x in rng.integers(1, 101, 300)], "length long, offset int")
    got = local(packing.pack(items, capacity=100, block_rows=64))
    assert len(got) == 300 and check_packed(got, 100) <= 1.08 * -(-sum(r["length"] for r in got) // 100)
    with pytest.raises(Exception, match="out of range"):
        packing.pack(spark.createDataFrame([(101,)], "length long"), capacity=100).collect()


def triples(rng, bins, capacity=1000):
    """Lengths cut from full bins, three of each: the least number of bins is known."""
    out = []
    for _ in range(bins):
        a = int(rng.integers(380, 490))
        b = int(rng.integers(250, (capacity - a) // 2))
        out += [a, b, capacity - a - b]
    return out


def best_fit_bins(size, capacity):
    first = packing.Grouping(size, capacity, [])
    first.best_fit(list(range(len(size))))
    return len(first.bins)


@pytest.mark.parametrize("bins", [20, 40, 83])
def test_evolution_beats_best_fit(bins):
    size = triples(np.random.default_rng(bins), bins)
    plain = best_fit_bins(size, 1000)
    started = packing.evolve(size, 1000, [], [0], 8, 0)     # the first groupings only
    grown = packing.evolve(size, 1000, [], [0], 8, 20)
    assert sorted(i for b in grown.bins for i in b) == list(range(len(size)))
    assert max(sum(size[i] for i in b) for b in grown.bins) <= 1000 and grown.load == [sum(size[i] for i in b) for b in grown.bins]
    assert len(started.bins) >= plain - 1 and len(grown.bins) <= plain - 3 and len(grown.bins) <= 1.1 * bins


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(8)
    size = rng.integers(1, 400, 300).tolist()
    for _ in range(30):
        parents = []
        for _ in range(2):
            g = packing.Grouping(size, 1000, [])
            for part in np.array_split(rng.permutation(300), 5):
                g.best_fit(part.tolist())
            parents.append(g)
        child = packing.crossover(*parents, rng)
        assert sorted(i for b in child.bins for i in b) == list(range(300)) and max(child.load) <= 1000
        whole = {tuple(sorted(b)) for b in parents[0].bins}
        assert any(tuple(sorted(b)) in whole for b in child.bins)


def test_elites_migrate_between_islands(spark):
    """A grouping that one island was given is on its neighbour one epoch later, so the
    packing of a table is not worse than the best of its islands alone."""
    size = triples(np.random.default_rng(5), 40)
    items = scratch(spark.createDataFrame([(x,) for x in size], "length long"), "items")
    used = {}
    for islands, epochs in ((1, 1), (3, 3)):
        got = local(packing.pack(items, capacity=1000, islands=islands, epochs=epochs, generations=6))
        assert sorted(r["length"] for r in got) == sorted(size)
        used[islands] = check_packed(got, 1000)
    assert used[3] <= used[1] < best_fit_bins(size, 1000) and used[3] <= 43


# ---- sharding --------------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 3, 16])
def test_sharding(spark, docs, none, shards):
    table = docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 1).where(F.col("size") < 3000)
    dims = [sharding.text_position(F.col("source")), F.log1p("size"), F.col("doc_id")]
    got = local(sharding.shard(table, F.col("size"), dims, shards))
    assert len(got) == table.count()
    sizes = Counter()
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
        sizes[s] = sum(r["size"] for r in got if r["shard"] == s)
    largest = max(r["size"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 5 * largest
    assert sharding.shard(none.withColumn("size", F.lit(1)), F.col("size"), dims, shards).count() == 0


def test_sharding_parts_one_value(spark):
    rows = spark.range(4000).select(F.lit(10).alias("size"), F.lit(1.0).alias("x"), F.lit(None).cast("double").alias("y"))
    got = Counter(r["shard"] for r in local(sharding.shard(rows, F.col("size"), [F.col("x"), F.col("y")], 16)))
    assert len(got) == 16 and max(got.values()) - min(got.values()) <= 4


def test_sharding_of_very_long_rows(spark):
    """Rows of several mean shards lie alone; the others share what is left evenly."""
    sizes = [700_000, 300_000, 290_000] + [50 + i % 100 for i in range(20_000)]
    table = scratch(spark.createDataFrame([(i, n, float(i % 7)) for i, n in enumerate(sizes)], "id long, size long, x double"), "long")
    got, count = Counter(), Counter()
    rows = local(sharding.shard(table, F.col("size"), [F.col("x"), F.log1p("size")], 16))
    for r in rows:
        got[r["shard"]] += r["size"]
        count[r["shard"]] += 1
    assert len(rows) == len(sizes) and sorted(got) == list(range(16))
    assert sorted(got[r["shard"]] for r in rows if r["size"] > 1000) == [290_000, 300_000, 700_000]
    rest = [got[s] for s in got if count[s] > 1]
    assert len(rest) == 13 and max(rest) - min(rest) <= 2000
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(count[s])) for s in got)


# ---- secrets ---------------------------------------------------------------------

def test_secret_links(spark, docs, none):
    key = "Zk9" + "aB3x" * 6
    text = (f"login: alice42 x {key} y https://db.example.org/in\n\nplain {key} alone\n\nAKIA{'A1' * 8} near {key}"
            f"\n\npassword = hunter2222 {'0a' * 14} token: ab")
    (found,) = secret_scan.scan([text])
    kinds = Counter(secret_scan.KINDS[k] for _, k, _ in found)
    assert kinds == {"identifier": 1, "secret": 2, "endpoint": 1, "access": 1, "assign": 1, "hex": 1}
    assert all(text[a:b] != key or "alone" not in text[b:b + 8] for a, _, b in found)
    assert secret_scan.scan([None, "", "user: bob99 only"]) == [[], [], []]
    clean = secret_scan.redacted(text, found)
    assert key in clean and clean.count("[SECRET]") == 7 and "hunter" not in clean
    frame = spark.createDataFrame([(1, text, len(text), "a"), (2, None, None, "b")], "doc_id long, text string, n_chars long, spans string")
    got = {r["doc_id"]: r for r in local(secret_scan.redact(frame))}
    assert got[1]["text"] == clean and got[1]["n_chars"] == len(clean) and got[2]["text"] is None and got[2]["spans"] == "b"
    assert local(secret_scan.redact(docs)) == local(docs) and secret_scan.secret_spans(none).count() == 0


def test_secret_keys_of_any_length_and_scope():
    import base64
    for key in (*(base64.b64encode(bytes(range(n))).decode() for n in (30, 31, 32, 64)), "aB3x" * 45, "Zk9/" * 500):
        for text in (f"client_id: acme-prod, key: {key}", f"client_id: acme-prod, key: '{key}'.", f"key={key}&client_id=acme-prod"):
            (found,) = secret_scan.scan([text])
            assert key in [text[a:b] for a, k, b in found if k == 3] and key not in secret_scan.redacted(text, found)
    key = "Zk9" + "aB3x" * 6
    text = f"login: alice42 {'word ' * 300}{key} {'word ' * 300}ssh://db.example.org"
    assert [k for _, k, _ in secret_scan.scan([text, None])[0]] == [4, 3, 5]
    assert secret_scan.scan([text.replace(" word", "\n\nword", 1)]) == [[]]
    name = "name_of_some_setting_1"
    assert secret_scan.scan([f"login: alice42 {name}=x"]) == [[]]
    (found,) = secret_scan.scan([f"login: alice42 {name}={key}"])
    assert [k for _, k, _ in found] == [4, 3]
    assert secret_scan.scan(["x" * 19 + " " + "1z" * 10 ** 6]) == [[]]


def test_secret_linking_recall_and_precision():
    import base64
    import uuid
    rng = np.random.default_rng(17)
    kinds = [lambda: base64.b64encode(rng.bytes(int(rng.integers(20, 50)))).decode(), lambda: str(uuid.UUID(bytes=rng.bytes(16))),
             lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 32))]
    keys = [kinds[i % 3]() for i in range(300)]
    found = secret_scan.scan([f"login: bob{i} uses {k} here" for i, k in enumerate(keys)])
    assert sum(any(c == 3 for _, c, _ in f) for f in found) >= 294
    alone = secret_scan.scan([f"the part {k} is here" for k in keys])
    assert not any(alone)
    plain = ["https://example.org/blog/2024/long-article-title-here", "/usr/share/python3/site-packages/module_name",
             "/home/user7/projects/reports-2023/final_version_2", "some-very-long-branch-name-12", "TheClassNameOfSomeModule2",
             "https://example.org/p/aB3xZk9aB3xZk9aB3xZk9aB3x/page", "2024-11-05_release_notes_v2"]
    assert all(k == 4 for p in plain for _, k, _ in secret_scan.scan([f"user: bob99 see {p} for more"])[0])
    linked = "https://bob99:aB3xZk9aB3xZk9aB3xZk9@db.example.org/in"
    assert {k for _, k, _ in secret_scan.scan([f"user: bob99 at {linked}"])[0]} == {3, 4, 5}


def base_spans(text):
    """The base rules of the contract, spelled out."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_op3_base_columns(spark, tmp_path):
    rng = np.random.default_rng(23)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "'", '"', " ", "  ", ":", "=", "hunter22", "abc", "é", "\n",
            "AKIA" + "A1" * 8, "AKIAX", "0a" * 12, "0a" * 11, "f" * 30, "😀", "x.y-z/+_=", "ſecret", "toKen"]
    texts = ["".join(rng.choice(bits, int(rng.integers(0, 40)))) for _ in range(400)] + [None, "", "0" * 100_000, "secret=" * 2000]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in local(queries.op3_secret_links(spark, str(tmp_path)))}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = base_spans(t)
        names = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert [got[i][f"n_{k}"] for k in secret_scan.KINDS[:3]] == [sum(x[1] == j for x in base) for j in range(3)]
        assert got[i]["base_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert set(names.split(",")) <= set(got[i]["spans"].split(","))


# ---- archive ---------------------------------------------------------------------

def test_archive_round_trip(spark):
    long = "<p>" + "é" * 200
    rows = [(5, "u5", long, 1), (3, "u3\r\nX: y", long, 1), (7, None, "short", 1), (8, "u8", "short", 1), (9, "u9", None, 1),
            (3, "u3\r\nX: y", long, 1), (None, "n", long, 1), (10, "u10", long + "x", 1)]
    path = scratch_path(spark, "t")
    warc.write(scratch(spark.createDataFrame(rows, "page_id long, url string, html string, digest int"), "pages"), path)
    got = local(warc.records(spark, path))
    assert len(got) == len(rows) and spark.read.parquet(path + "/payloads").count() == 4
    responses = [r for r in got if r["record_type"] == "response" and r["payload_bytes"] >= 100]
    assert sorted(r["page_id"] for r in responses) == [3, 10]
    assert all(r["refers_to"] == 3 for r in got if r["record_type"] == "revisit")
    ids = {}
    for r in got:
        head, _, block = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and b"\nX: y" not in head
        assert fields["WARC-Date"] == "1970-01-01T00:00:00Z" and fields["WARC-Record-ID"] not in ids
        ids[fields["WARC-Record-ID"]] = (r["record_type"], r["digest"])
        assert block.endswith(b"\r\n\r\n") and len(block) == int(fields["Content-Length"]) + 4
        http, _, body = block[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n") and f"Content-Length: {len(bytes(r['payload']))}".encode() in http
        assert body == (bytes(r["payload"]) if r["record_type"] == "response" else b"")
    for r in got:
        refers = re.search(rb"WARC-Refers-To: (\S+)", bytes(r["record"]))
        assert (refers is not None) == (b"WARC-Profile" in bytes(r["record"])) == (r["record_type"] == "revisit")
        assert refers is None or ids[refers[1].decode()] == ("response", r["digest"])
    path = scratch_path(spark, "t")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.records(spark, path).count() == 0


def test_archive_notices_changed_payloads(spark):
    path = scratch_path(spark, "t")
    warc.write(spark.createDataFrame([(1, "u", "a" * 200), (2, "v", "b" * 200)], "page_id long, url string, html string"), path)
    changed = scratch(spark.read.parquet(path + "/payloads").withColumn("payload", F.concat("payload", F.lit(b"x"))), "changed")
    changed.write.mode("overwrite").parquet(path + "/payloads")
    with pytest.raises(Exception, match="does not match its address"):
        warc.records(spark, path).collect()


def test_files_notice_changed_blocks(spark, docs):
    path = scratch_path(spark, "t")
    rans.write(docs, path, queries.WORD_TOKENIZER)
    blocks = spark.read.parquet(path + "/blocks")
    scratch(blocks.withColumn("crc32", F.col("crc32") + 1), "changed").write.mode("overwrite").parquet(path + "/blocks")
    with pytest.raises(Exception, match="checksum differs"):
        rans.read(spark, path).collect()


def test_op5_revisits(spark, tmp_path):
    rng = np.random.default_rng(31)
    bodies = ["<p>" + "é" * n for n in (48, 49, 60, 97, 98, 500)] + ["", None, "x" * 99, "x" * 100]
    pages = [(int(i), f"u{i}", bodies[int(rng.integers(len(bodies)))]) for i in rng.permutation(200)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    first = {}
    for i, _, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault(html or "", i)
    got = {r["page_id"]: r for r in local(queries.op5_warc_archive(spark, str(tmp_path)))}
    assert len(got) == len(pages)
    for i, _, html in pages:
        data = (html or "").encode()
        again = len(data) >= 100 and first[html or ""] != i
        assert (got[i]["payload_bytes"], got[i]["payload_digest"], got[i]["record_type"], got[i]["refers_to"]) == (
            len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None)


# ---- vectors ---------------------------------------------------------------------

def test_nearest(spark):
    rng = np.random.default_rng(5)
    v = {i: rng.normal(size=6).tolist() for i in range(150)}
    v |= {150 + i: v[0] for i in range(15)} | {200: None, 201: [0.0] * 6, 202: [float("nan")] * 6, 203: [1.0, None, 1.0, 1.0, 1.0, 1.0], 204: [1.0, 2.0]}
    table = scratch(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>"), "vec")
    got = {}
    for r in local(ann.nearest(table, F.col("vec_id") % 50 == 0, k=10, row_group=40, query_group=2)):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    good = {i: np.array(x) for i, x in v.items() if i < 200}
    for q in (0, 50, 100, 150):
        want = sorted((float(ann.distance(good[q][None], x[None])[0]), i) for i, x in good.items() if i != q)[:10]
        assert [got[q][k + 1] for k in range(10)] == want
    assert set(got) == {0, 50, 100, 150}
    assert ann.nearest(table.limit(0), F.lit(True)).count() == 0


def test_nearest_of_any_size(spark):
    """Components whose squares leave the range of doubles, against exact fractions."""
    from fractions import Fraction
    rng = np.random.default_rng(9)
    v = {i: (rng.normal(size=4) * 10.0 ** (200, -200, 0, 300, -160, 307)[i % 6]).tolist() for i in range(60)}
    v |= {60: [1e308, 0.0, 0.0, 0.0], 61: [-1e308, 0.0, 0.0, 0.0], 62: v[0], 63: [5e-324, 0.0, 0.0, 0.0]}
    table = scratch(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>"), "vec")
    got = {}
    for r in local(ann.nearest(table, F.lit(True), k=5, row_group=20, query_group=30)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(v)
    for q, found in got.items():
        square = {i: sum((Fraction(a) - Fraction(b)) ** 2 for a, b in zip(v[q], x, strict=True)) for i, x in v.items() if i != q}
        want = sorted(square.values())[:5]
        for (_, i, score), exact in zip(sorted(found), want, strict=True):
            assert abs(square[i] - exact) <= exact * Fraction(1, 10 ** 12)
            assert abs(Fraction(score) ** 2 - square[i]) <= square[i] * Fraction(1, 10 ** 12)


# ---- quality ---------------------------------------------------------------------

def test_quality_removes_frequent_lines(spark, none):
    rng = np.random.default_rng(2)
    pool = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(40):
        own = " ".join(rng.choice(pool, 70, replace=False))
        rows.append((i, f"Shared  Line 7 of the site\n{own}" if i < 30 else own, "h", 0))
    rows += [(100, "\n".join(["shared line 3 of the site"] * 40), "h", 0), (101, rows[0][1], "h", 0), (102, None, None, 0), (103, rows[35][1], "h", 0)]
    table = scratch(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long"), "q")
    got = {r["doc_id"]: r for r in local(quality.judge(table, line_share=0.3))}
    assert all(got[i]["kept"] for i in [*range(40), 101, 103]) and not got[100]["kept"] and not got[102]["kept"]
    assert got[0]["removed_words"] == 6 and got[0]["removed"] == [0] and got[35]["removed_words"] == 0
    kept = {r["doc_id"]: r for r in local(quality.clean(table, line_share=0.3))}
    assert set(kept) == {*range(40), 101, 103} and kept[0]["text"] == rows[0][1].split("\n")[1] and kept[0]["n_chars"] == len(kept[0]["text"])
    assert quality.judge(none).count() == 0


def test_quality_repeats(spark, docs):
    for r in local(quality.judge(docs).join(docs.withColumn("_rid", F.monotonically_increasing_id()).select("_rid", "text"), "_rid")):
        text = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        n = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if n[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))


def same_hash_windows(n):
    """Pairs of three words each, different but with one 64-bit hash in Spark's xxhash64."""
    mask, one, two, five = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5

    def turned(x, r):
        return (x << r | x >> 64 - r) & mask

    def seed(*words):
        h = 42
        for w in words:
            h = xxhash.xxh64_intdigest(w, h)
        return h

    found, i = [], 0
    while len(found) < n:
        i += 1
        a, b = (f"a{i}", "y", "abcdefgh"), (f"b{i}", "y")
        k = turned(int.from_bytes(a[2].encode(), "little") * two & mask, 31) * one & mask
        k ^= (seed(*a[:2]) + five + 8 & mask) ^ (seed(*b) + five + 8 & mask)
        k = turned(k * pow(one, -1, 1 << 64) & mask, 33) * pow(two, -1, 1 << 64) & mask
        last = k.to_bytes(8, "little")
        if all(33 <= c <= 126 for c in last):
            found.append((" ".join(a), " ".join([*b, last.decode()])))
            assert seed(*a) == seed(*b, last.decode())
    return found


def test_quality_repeats_with_equal_hashes(spark):
    (a, b), (c, d) = same_hash_windows(2)
    texts = [f"{a} q1 {b} q2", f"{a} q1 {b} q2 {a} q3", f"{a} q1 {b} q2 {a} q3 {b}", f"{c} q1 {d} q2 {a} q3 {b} q4 {d} q5 {c} q6 {a}", f"{a} q1 {a}"]
    rows = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in local(quality.judge(scratch(rows, "equal")))}
    assert got == {0: 0, 1: 6, 2: 12, 3: 18, 4: 6}


# ---- near-duplicates -------------------------------------------------------------

def fingerprint(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark, docs, none):
    rows = local(docs)
    prints = [fingerprint(r["text"] or "") for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min(root[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 4) for i in range(len(rows))]
    least = {k: min(r["doc_id"] for r, g in zip(rows, root) if g == k and r["doc_id"] is not None) for k in set(root)}
    want = Counter((r["doc_id"], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, root))
    got = local(simhash.near_duplicates(docs, tile_rows=7))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    first = local(simhash.first_of_groups(docs))
    assert sorted(r["doc_id"] for r in first) == sorted(least.values()) and set(first[0]) == set(docs.columns)
    assert simhash.near_duplicates(none).count() == 0


def test_local_roots():
    rng = np.random.default_rng(8)
    for edges in (5, 60, 90, 200):
        a, b = rng.integers(0, 100, edges), rng.integers(0, 100, edges)
        want = list(range(100))
        for _ in range(100):
            for i, j in zip(a, b):
                want[i] = want[j] = min(want[i], want[j])
        assert local_roots(a, b, 100).tolist() == want


def test_components(spark):
    rng = np.random.default_rng(9)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    root = local_roots(a, b, 300)
    edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist())) + [(400 + i, 401 + i) for i in range(60)], "a long, b long")
    got = {r["node"]: r["root"] for r in local(components(edges))}
    touched = {i for i, j in zip(a, b) if i != j} | {j for i, j in zip(a, b) if i != j}
    assert got == {int(i): int(root[i]) for i in touched} | {400 + i: 400 for i in range(61)}


def test_tiles_find_every_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2 ** 63, 900, dtype=np.uint64) * 2
    x = np.concatenate([x, x[:300] ^ np.uint64(0x8001), x[:200] ^ np.uint64(31)])
    found = {(min(a, b), max(a, b)) for i, j in simhash.close_pairs(x, x, 4) for a, b in zip(i.tolist(), j.tolist()) if a != b}
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None]) <= 4)
    assert found == {(i, j) for i, j in zip(a.tolist(), b.tolist()) if i < j}


# ---- lines -----------------------------------------------------------------------

def test_line_matches(spark, docs, none):
    rows = local(docs.withColumn("_rid", F.monotonically_increasing_id()))
    lines = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["_rid"], n), x.strip().lower()) for r in rows
                   for n, x in enumerate((r["text"] or "").split("\n")) if x.split())
    first, sets = {}, {}
    for place, x in lines:
        first.setdefault(x, place)
        sets[x] = set(x.split())
    near = {x: [y for y in sets if y != x and 10 * len(sets[x] & sets[y]) >= 8 * len(sets[x] | sets[y])] for x in sets}
    want = {place[2:]: (len(near[x]), min(first[y] for y in [x, *near[x]]) < place) for place, x in lines}
    got = {(r["_rid"], r["line"]): (r["n_links"], r["removed"]) for r in local(line_dedup.line_matches(docs))}
    assert got == want and any(v[0] for v in want.values())
    kept = Counter((r["doc_id"], r["text"] and "\n".join(
        x for n, x in enumerate(r["text"].split("\n")) if not want.get((r["_rid"], n), (0, False))[1])) for r in rows)
    out = local(line_dedup.dedup_lines(docs))
    assert Counter((r["doc_id"], r["text"]) for r in out) == kept and list(out[0]) == docs.columns
    assert line_dedup.line_matches(none).count() == 0


def test_lines_and_their_words_are_read_in_one_pass(spark, docs, none):
    """op9: one pass gives the places of all lines and the counts of the frequent words."""
    table = docs.withColumn("_rid", F.monotonically_increasing_id())
    rows = local(table)
    found, often = line_dedup.lines_and_words(table, 500)
    plain = [(r["_rid"], r["doc_id"], n, x.strip().lower()) for r in rows for n, x in enumerate((r["text"] or "").split("\n")) if x.split()]
    got = Counter((r["_rid"], r["doc_id"], r["line"], r["h"]) for r in local(found))
    assert got == Counter((rid, doc, n, line_dedup.content_hash(x)) for rid, doc, n, x in plain) and got
    words = Counter(w for x in {x for *_, x in plain} for w in x.split())
    code = dict(zip(words, line_dedup.split_words([" ".join(words)])[2].tolist(), strict=True))
    most = Counter(w for *_, x in plain for w in x.split())     # tasks may count a line each
    frequent = {w for w, n in words.items() if n * 250 >= most.total()}
    assert {code[w] for w in frequent} <= set(often) <= set(code.values()) and len(often) <= 500 and frequent
    assert all(words[w] - most.total() / 500 < often[code[w]] <= most[w] for w in frequent)
    lines, often = line_dedup.lines_and_words(none.withColumn("_rid", F.monotonically_increasing_id()), 50)
    assert lines.count() == 0 and not often
    sets = line_dedup.word_sets(["b a b", "x", " a  é "]).to_pylist()
    digest = lambda w: line_dedup.content_hash(w) ^ -1 << 63
    assert sets == [sorted(map(digest, x.split())) for x in ("a b", "x", "a é")]


def test_shared_words_are_counted_in_bounded_steps(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, int(rng.integers(1, 12)))) for _ in range(60)]
    whole = [(i, found.tolist()) for i, found in line_dedup.matches(sets, sets, 0.5)]
    for most in (1, 100, 5000):
        monkeypatch.setattr(line_dedup, "MOST_CELLS", most)
        assert [(i, found.tolist()) for i, found in line_dedup.matches(sets, sets, 0.5)] == whole


def test_window_and_blocks_equal_brute_force():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40, int(rng.integers(3, 12)))) for _ in range(200)]
    for i, found in line_dedup.matches(sets, sets, 0.8):
        want = [j for j, s in enumerate(sets) if 10 * len(np.intersect1d(s, sets[i])) >= 8 * len(np.union1d(s, sets[i]))]
        assert found.tolist() == want


def test_words_are_split_and_told_apart_by_the_column():
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [x for x in ODD if x] + ["a".join(spaces) + "b", "x" * 65 + " " + "x" * 66 + " " + "é" * 70_000 + " x", "ab ba a b " * 9000, "  ", ""]
    counts, index, words = line_dedup.split_words(texts)
    split = [t.split() for t in texts]
    assert counts.tolist() == [len(x) for x in split]
    of = {}
    for word, key in zip([w for x in split for w in x], words[index].tolist(), strict=True):
        assert of.setdefault(word, key) == key
    assert len(set(of.values())) == len(of) == len(np.unique(index))
    alone = {w: int(line_dedup.split_words([w])[2][0]) for w in of}
    assert alone == of                                  # whatever stands beside it


def test_prefix_of_rarest_words():
    rng = np.random.default_rng(3)
    lines = [" ".join(rng.choice(WORDS, int(rng.integers(1, 30)))) + f" {i % 7}" for i in range(50)]
    counts, index, words = line_dedup.split_words(lines)
    often = {int(w): int(n) for w, n in zip(words, np.bincount(index)) if n > 20}
    rare = line_dedup.by_rarity(often)
    found = line_dedup.prefixes(lines, rare, 0.8)
    key = dict(zip([w for x in lines for w in x.split()], line_dedup.word_keys(words, rare)[index].tolist(), strict=True))
    for i, line in enumerate(lines):
        want = sorted(key[w] for w in set(line.split()))
        mine = found["owner"] == i
        assert found["word"][mine].tolist() == want[:len(want) - -(-8 * len(want) // 10) + 1]
        assert set(found["size"][mine].tolist()) == {len(want)}


def test_window_takes_sizes_that_do_not_fit_the_number():
    big = line_dedup.MOST_SIZE
    rows = lambda *sizes: np.array([[100 + s % 97 for s in sizes], sizes, [0] * len(sizes), [0] * len(sizes), [0] * len(sizes)], np.int64)
    window = line_dedup.Window(0.8)
    window.meet(rows(big - 5))
    a, b = window.meet(rows(2 * big, big + 9))          # not in order: both have the number of MOST_SIZE
    assert {*a.tolist(), *b.tolist()} == {100 + s % 97 for s in (big - 5, big + 9)}
    a, b = window.meet(rows(big + 8, 2 * big + 1))
    assert {*a.tolist(), *b.tolist()} == {100 + s % 97 for s in (big - 5, big + 9, 2 * big, big + 8, 2 * big + 1)}


# ---- binary format ---------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 600_000])
def test_coder_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 49000
    symbols, counts = np.unique(ids, return_counts=True)
    model = rans.Model(symbols, rans.scaled(counts) if n else counts)
    words, states, cursors = rans.encode_block(ids, model)
    assert (rans.decode_block(words, states, cursors, n, model) == ids).all()


def test_binary_files(spark, docs, none):
    path = scratch_path(spark, "rans")
    rans.write(docs, path, queries.WORD_TOKENIZER, parts=3)
    got = sorted(local(rans.read(spark, path, with_ids=True)), key=lambda r: r["start"])
    library, start = Tokenizer.from_file(queries.WORD_TOKENIZER), 0
    rows = sorted(local(docs), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    for r, d in zip(got, rows, strict=True):
        ids = np.array(library.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        assert (r["doc_id"], r["start"], bytes(r["ids"]), r["ids_crc32"]) == (d["doc_id"], start, ids, zlib.crc32(ids))
        start += r["n_tokens"]
    path = scratch_path(spark, "rans")
    rans.write(none, path, queries.WORD_TOKENIZER)
    assert rans.read(spark, path).count() == 0


def test_pipeline_small(spark, docs):
    import corpus_pipeline
    rows = docs.drop("shard")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, scratch(stage(spark, rows, ""), "stage")
        assert rows.columns == before.columns and rows.count() <= before.count()
    last = local(corpus_pipeline.STAGES[-1][1](spark, rows, ""))
    assert {r["doc_id"] for r in last} == {r["doc_id"] for r in local(rows)} and check_packed(last, 4096) > 0
    texts = [r["text"] for r in local(rows)]
    prints = [fingerprint(t) for t in texts]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])


@pytest.mark.parametrize("stage", [quality.clean, line_dedup.dedup_lines, simhash.first_of_groups])
def test_stages_number_rows_once(spark, stage):
    rng = np.random.default_rng(6)
    own = [" ".join(f"w{x}" for x in rng.choice(5000, 60, replace=False)) for _ in range(24)]
    texts = [t + "\n" + own[0] if i % 3 else "too short" for i, t in enumerate(own)]
    rows = [(i, t, "h", len(t)) for i, t in enumerate(texts)]
    path = scratch_path(spark, "parts")
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(6).write.parquet(path)
    name = "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(name, "1")
        want = Counter(stage(spark.read.parquet(path)).collect())
        out = stage(spark.read.parquet(path))
        spark.conf.set(name, "6")               # as if cores joined before the rows are read again
        assert Counter(out.collect()) == want and len(want) > 1
    finally:
        spark.conf.unset(name)
