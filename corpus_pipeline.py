"""The corpus pipeline: five stages from ``documents`` to packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
a DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All
but the last return the columns of ``documents``.

1. quality rules: rejected documents go, lines above the limits go from the others;
2. line dedup: the later lines of every match go (a text may become empty);
3. SimHash near-dedup: of each group the document with the smallest id stays;
4. secret scans: reported spans are replaced by ``[SECRET]``;
5. best-fit packing: the ids of every text, cut and packed into sequences.

A null text fails the quality rules, so later stages see none from ``run``; each stage
takes them all the same (see its operator for null, empty, long and repeated rows).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wordlens.llm import line_dedup, packing, quality, secret_scan, simhash
from wordlens.llm.common import recorded, release
from wordlens.llm.queries import WORD_TOKENIZER
from wordlens.session import drop_scratch, read_table, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: scratch folders of the stage that ran last, by application
_BEHIND: dict[str, list[str]] = {}


def tidy(stage: Stage) -> Stage:
    """A stage that first removes the scratch tables of the stage before it: that one's
    result has been written and is what this one reads."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _BEHIND.pop(spark.sparkContext.applicationId, []))
        with recorded() as made:
            out = stage(spark, docs, sf_dir)
        _BEHIND[spark.sparkContext.applicationId] = made
        return out

    return run_stage


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


@tidy
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, threshold=0.8)


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_groups(docs, size=4, radius=4)


@tidy
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


@tidy
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, WORD_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: The shingle hashes and the packing have no SQL form: the tests hold ``run`` against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch(stage(spark, docs, sf_dir), f"stage{number + 1}")
        if before is not None:
            drop_scratch(before)
        before = docs
    return docs
