"""Plan properties that matter at scale (checked on the small driver tables)."""

import re

import pytest

from wordlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyword_stats_plan(spark):
    p = plan(QUERIES["keyword_stats"](spark, SF))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
    hash_exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len(hash_exchanges) == 1 and hash_exchanges[0].startswith("term")
    # column pruning: the scan reads the text column only
    assert "FileScan parquet [text#" in p


def test_report_first_seen_stays_hash_aggregate(spark):
    from wordlens.operators import keywords
    from wordlens.plans.queries import documents_corpus
    stats = keywords.keyword_stats(documents_corpus(spark, SF), with_first_seen=True)
    p = plan(stats)
    assert "SortAggregate" not in p and "HashAggregate" in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_building_a_corpus_runs_no_job_and_adds_no_shuffle(spark):
    from wordlens.sources.corpus import build_corpus
    docs = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    spark.sparkContext.setJobGroup("build", "build a corpus of an aggregated table")
    corpus = build_corpus(docs.groupBy("doc_id").agg({"text": "max"}).withColumnRenamed("max(text)", "text"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs and corpus.keys == ("doc_id", "sent_no")
    assert "RoundRobinPartitioning(" not in plan(build_corpus(docs).df)
    assert "RoundRobinPartitioning(4" in plan(build_corpus(docs, partitions=4).df)


@pytest.mark.parametrize("name", ["sentences", "tokens", "centre_suffix", "rotated_sentence", "term_counts",
                                  "distance", "element_counts", "keyword_stats", "wordlist_hits"])
def test_one_scan(spark, name):
    assert plan(QUERIES[name](spark, SF)).count("FileScan parquet") == 1


def test_report_plan_before_its_checkpoint(spark):
    from wordlens.operators import keywords
    from wordlens.plans.queries import documents_corpus
    corpus = documents_corpus(spark, SF)
    p = plan(keywords._stats(keywords.stat_rows(corpus, 0, markers=True), corpus, [], True))
    assert p.count("FileScan parquet") == 1 and p.count("Exchange hashpartitioning(") == 1
    assert "SortAggregate" not in p and "Window" not in p and "Join" not in p
    logical = keywords.stat_rows(corpus)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_arrays" not in logical and "array_position" not in logical
