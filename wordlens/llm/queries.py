"""One query per operator over its whole table, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.llm import ann, bpe, clusters, line_dedup, merkle, packing, quality, rans, secret_scan, sharding, simhash, toxicity, warc
from wordlens.llm.common import scratch_path
from wordlens.session import read_table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packing.pack(pieces)


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "lang", "source")
    dimensions = [sharding.text_position(F.col("source")), sharding.text_position(F.col("lang")), F.log1p("size"), F.col("doc_id")]
    return sharding.shard(docs, F.col("size"), dimensions, shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(read_table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(read_table(spark, sf_dir, "documents"), BYTE_TOKENIZER)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(read_table(spark, sf_dir, "pages"), path)
    refers = F.nullif(warc.field("WARC-Refers-To"), F.lit(""))
    return warc.records(spark, path).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), warc.field("WARC-Type").alias("record_type"),
        F.regexp_extract(refers, r"^<urn:page:(-?\d+):", 1).cast("long").alias("refers_to"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).drop("_rid", "removed")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), size=4, radius=4)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_matches(read_table(spark, sf_dir, "documents"), threshold=0.8).drop("_rid")


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rans")
    rans.write(read_table(spark, sf_dir, "documents"), path, WORD_TOKENIZER)
    return rans.read(spark, path)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(read_table(spark, sf_dir, "embeddings"), k=16, rounds=3, scale=64, width=64)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_kd_sharding": op2_kd_sharding,
    "op3_secret_links": op3_secret_links,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_warc_archive": op5_warc_archive,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_binary": op10_token_binary,
    "op11_toxicity": op11_toxicity,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_merkle_manifest": op13_merkle_manifest,
}



def _kmeans_sql(rounds: int = 3) -> str:
    """The rounds of ``op12`` one after the other, in whole numbers."""
    def assigned(name: str, centroids: str) -> str:
        return f"""
{name} AS (
  SELECT rid, c, d FROM (
    SELECT x.rid, z.c, sum((x.x - z.x) * (x.x - z.x)) AS d, row_number() OVER (PARTITION BY x.rid ORDER BY sum((x.x - z.x) * (x.x - z.x)), z.c) AS r
    FROM x JOIN {centroids} z USING (i) GROUP BY x.rid, z.c) WHERE r = 1)"""

    def moved(name: str, centroids: str, by: str) -> str:
        return f"""
{name} AS (
  SELECT z.c, z.i, coalesce(m.x, z.x) AS x FROM {centroids} z LEFT JOIN (
    SELECT a.c, x.i, CAST(floor(CAST(sum(x.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM {by} a JOIN x USING (rid) GROUP BY a.c, x.i) m USING (c, i))"""

    steps = []
    for k in range(rounds):
        steps += [assigned(f"a{k}", f"c{k}"), moved(f"c{k + 1}", f"c{k}", f"a{k}")]
    steps.append(assigned("a", f"c{rounds}"))
    return """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT rid, generate_subscripts(v, 1) AS i, CAST(floor(64 * unnest(v)) AS BIGINT) AS x FROM v),
f AS (SELECT rid, CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS c FROM v),
c0 AS (SELECT f.c, x.i, x.x FROM f JOIN x USING (rid) WHERE f.c < 16),""" + ",".join(steps) + f""",
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, a.c AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a JOIN v USING (rid) JOIN h ON a.c = h.c"""


def _merkle_sql() -> str:
    """The trees level by level (recursive), then every leaf's way up."""
    def part(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def tree(name: str, leaves: str) -> str:
        """Nodes (s, level, i, h, n) of all trees; n nodes are on the level."""
        return f"""
{name} AS (
  SELECT s, 0 AS level, i, h, count(*) OVER (PARTITION BY s) AS n FROM {leaves}
  UNION ALL
  SELECT s, level, i, h, count(*) OVER (PARTITION BY s) AS n FROM (
    SELECT s, level + 1 AS level, i // 3 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM {name} WHERE n > 1 GROUP BY s, level + 1, i // 3))"""

    def way(name: str, leaves: str, nodes: str) -> str:
        """For every leaf and level the siblings before and after it."""
        return f"""
{name} AS (
  SELECT a.s, a.i AS leaf, b.level, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i // CAST(pow(3, b.level) AS BIGINT)), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i // CAST(pow(3, b.level) AS BIGINT)), '') AS after
  FROM {leaves} a JOIN {nodes} b ON a.s = b.s AND b.n > 1 AND b.i // 3 = a.i // CAST(pow(3, b.level + 1) AS BIGINT)
  GROUP BY a.s, a.i, b.level)"""

    # crc32 bit by bit, lowest bit first
    crc = """(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda k:
      list_transform(range(8), lambda b: (CAST(ord(substr(CAST(doc_id AS VARCHAR), CAST(k + 1 AS INTEGER), 1)) AS BIGINT) >> CAST(b AS INTEGER)) & 1)))),
      lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) & 1) = 1"""
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {leaf("text")} AS h,
         CASE WHEN text IS NOT NULL AND doc_id IS NOT NULL AND {crc} THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS seen
  FROM documents),
names AS (SELECT source, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS s FROM (SELECT DISTINCT source FROM d)),
l AS (
  SELECT s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS i, doc_id, h, seen
  FROM d JOIN names ON d.source IS NOT DISTINCT FROM names.source),""" + tree("t", "l") + """,
sub AS (SELECT s AS i, h, 0 AS s FROM t WHERE n = 1),""" + tree("u", "sub") + "," + way("w", "l", "t") + "," + way("v", "sub", "u") + """,
steps AS (
  SELECT s, leaf, level, before, after FROM w
  UNION ALL SELECT l.s, l.i, 1000 + v.level, v.before, v.after FROM l JOIN v ON v.leaf = l.s),
ways AS (
  SELECT s, leaf, list({'a': before, 'z': after} ORDER BY level) AS way, string_agg(before || after, '' ORDER BY level) AS proof FROM steps GROUP BY s, leaf),
f AS (
  SELECT l.s, l.doc_id, l.h AS leaf, coalesce(proof, '') AS proof,
         CASE WHEN way IS NULL THEN l.seen ELSE list_reduce(list_prepend({'a': l.seen, 'z': ''}, way), lambda x, y: {'a': sha256(y.a || x.a || y.z), 'z': ''}).a END AS folded
  FROM l LEFT JOIN ways ON l.s = ways.s AND l.i = ways.leaf)
SELECT doc_id, leaf, sub.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = (SELECT h FROM u WHERE n = 1) AS verified
FROM f JOIN sub ON sub.i = f.s"""


ORACLE: dict[str, str] = {
    "op7_quality_rules": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, word, row_number() OVER (PARTITION BY rid ORDER BY i) AS i, word_len FROM (
        SELECT rid, unnest(ws) AS word, length(unnest(ws)) AS word_len, generate_subscripts(ws, 1) AS i
        FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d))),
g AS (SELECT rid, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n > 1),
rw AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (
         SELECT rid, i AS p FROM r UNION ALL SELECT rid, i + 1 FROM r UNION ALL SELECT rid, i + 2 FROM r) GROUP BY rid),
ww AS (SELECT rid, count(*) AS n_words, sum(word_len) AS word_chars FROM w GROUP BY rid),
l AS (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
ld AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
n AS (SELECT rid, host, t, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS line
      FROM l),
f AS (SELECT host, line, count(DISTINCT t) AS n FROM n WHERE line <> '' GROUP BY host, line),
h AS (SELECT host, count(DISTINCT t) AS documents FROM d GROUP BY host),
often AS (SELECT f.host, f.line FROM f JOIN h USING (host) WHERE f.n > 20 AND f.n > CAST(0.1 AS DOUBLE) * h.documents),
lost AS (SELECT rid, sum(len(string_split(line, ' '))) AS removed_words FROM n JOIN often USING (host, line) GROUP BY rid),
s AS (SELECT d.rid, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0) AS removed_words
      FROM d LEFT JOIN ww USING (rid) LEFT JOIN rw USING (rid) LEFT JOIN ld USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CAST(removed_words AS BIGINT) AS removed_words,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= CAST(0.5 AS DOUBLE) * n_words AS kept
FROM s""",
    "op6_nearest_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
           list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_warc_archive": """
WITH p AS (
  SELECT page_id, sha256(encode(coalesce(html, ''))) AS payload_digest,
         octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
h AS (SELECT payload_digest, min(page_id) AS holder FROM p GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 100 OR page_id = holder THEN NULL ELSE holder END AS refers_to
FROM p JOIN h USING (payload_digest)""",
    "op12_centroid_clusters": _kmeans_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}
