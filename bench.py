"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution,
nothing collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordlens.plans.queries import INPUT_PARTITIONS, QUERIES  # noqa: E402
from wordlens.session import local_session  # noqa: E402

HEADLINE = [
    "keyword_report",      # flagship
    "keyword_stats",
    "term_counts",
    "vocabulary_index",
    "keyword_sorted",
    "tokens",
    "positions_abs",
    "wordlist_abs",
    "centre_word",
    "slot_frequency",
    "distance",
    "axes_moved",
    "annotated_stats",
    "padded_sentences",
    "ragged_transpose_long",
    "rotated_sentence",
    "centre_suffix",
    "centre_by_positions",
    "keyword_drilldown",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app="wordlens-bench")
    spark.conf.set(INPUT_PARTITIONS, str(cpus))  # the tables are stored as one split each
    # warm-up of the JVM (JIT, expression codegen) on the smallest scale; not timed
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in ("keyword_report", "slot_frequency", "distance"):
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
