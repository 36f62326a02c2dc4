"""Keyword statistics over a stream of documents (Structured Streaming).

The batch keyword statistics (A8) are a single aggregation over per-sentence
term profiles, and every sentence arrives whole inside its document row, so
the same plan runs incrementally: each micro-batch profiles its new
sentences narrowly and the ``groupBy(term)`` keeps running sums in the
state store.  Results are those of the batch operator over all documents
seen so far (``binary``, ``count``, ``quote``, ``pos_index``, ``pct_index``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wordlens.functions.arrays import percent
from wordlens.operators.keywords import profile_rows
from wordlens.session import checkpoint_dir
from wordlens.sources.corpus import build_corpus


def running_keyword_stats(docs: DataFrame, text_col: str = "text",
                          doc_keys: Sequence[str] = ("doc_id",), level: int = 0) -> DataFrame:
    """Streaming DataFrame of running term statistics (update/complete mode)."""
    corpus = build_corpus(docs, text_col, doc_keys)
    prof = profile_rows(corpus, level)
    agg = prof.groupBy("term").agg(
        F.count(F.lit(1)).alias("binary"),
        F.sum("tf").alias("count"),
        F.sum("fp").alias("_sfp"),
        F.sum(percent(F.col("fp"), F.col("n_tokens"))).alias("_spct"),
    )
    return agg.select(
        "term", "binary", "count",
        (F.col("binary") / F.col("count")).alias("quote"),
        (F.col("_sfp") / F.col("binary")).alias("pos_index"),
        (F.col("_spct") / F.col("binary")).alias("pct_index"),
    )


def start_keyword_stream(spark: SparkSession, source_dir: str, schema: StructType,
                         query_name: str = "keyword_stats", level: int = 0, *,
                         sink: str, output_mode: str = "update",
                         checkpoint: str | None = None, available_now: bool = False,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the running statistics over Parquet files arriving in ``source_dir``.

    The state checkpoint goes below the session's shared checkpoint folder
    unless ``checkpoint`` is given.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.parquet(source_dir)
    stats = running_keyword_stats(docs, level=level)
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    writer = (stats.writeStream.outputMode(output_mode).format(sink)
              .queryName(query_name).option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
