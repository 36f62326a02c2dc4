import tempfile

from wordlens.operators import keywords
from wordlens.sources.corpus import build_corpus
from wordlens.streaming import start_keyword_stream


def test_stream_matches_batch(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    src = tempfile.mkdtemp(prefix="wl-stream-src-")
    docs.where("doc_id % 2 = 0").write.mode("overwrite").parquet(f"{src}/part=a")
    docs.where("doc_id % 2 = 1").write.mode("overwrite").parquet(f"{src}/part=b")
    ckpt = tempfile.mkdtemp(prefix="wl-stream-ckpt-")
    q = start_keyword_stream(spark, f"{src}/*", docs.schema, "wl_stream_test", sink="memory", output_mode="complete", checkpoint=ckpt,
                             available_now=True, max_files_per_trigger=1)
    q.awaitTermination(300)
    got = {(r.term, r.binary, r["count"]) for r in spark.sql("SELECT * FROM wl_stream_test").collect()}
    want = {(r.term, r.binary, r["count"]) for r in keywords.keyword_stats(build_corpus(docs)).collect()}
    assert got == want and len(got) > 1000
