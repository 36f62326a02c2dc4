"""Nearest neighbours by a block matrix join with quantisation error bounds.

Vectors are dealt into row groups (candidates) and column groups (queries); each cell of
the grid is one group of a co-grouped map.  In a cell, tiles of candidates meet tiles of
queries: every vector is scaled to 8-bit integers, the integer products of a tile come
from one matrix product, and with the exact length of what rounding left out they bound
every distance from both sides (Cauchy-Schwarz).  Pairs whose lower bound is beyond the
``k``-th upper bound or the current ``k``-th distance are dropped; all others are
computed again from the original vectors in double precision, and heaps of ``k`` per
query keep the nearest.  The heaps of a query's cells (``k`` rows each) are merged by one
ranking per query, which Spark cuts to ``k`` before its shuffle as well.
The bounds hold for every pair, so the result is exact.

The candidate side is copied once per column group (one per ``query_group`` queries), the
query side once per row group; no cell holds more than about ``row_group`` candidates.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part; vectors of different dimension are never compared; a row with the query's
own id is not its candidate; repeated rows of a query id with one vector ask once;
repeated candidate rows are candidates each; with fewer than ``k`` candidates all are
returned; ties go to the smaller id; finite components of any size are compared, also
where their squares leave the range of doubles.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlens.llm.common import ship

TILE = 1024
#: pairs whose vectors are gathered at once
PAIRS = 1 << 16
#: squared distances below this are too coarse for bounds
SMALL = 1e-290


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, all components finite."""
    big = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(integers -127..127, scale, length of the scaled integers, length of the rest)."""
    scale = np.abs(x).max(1) / 127
    codes = np.clip(np.rint(x / np.maximum(scale, np.finfo(float).tiny)[:, None]), -127, 127)
    near = codes * scale[:, None]
    # int8 values; their products are summed without rounding in this type
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    with np.errstate(over="ignore", under="ignore"):
        return codes.astype(np.int8).astype(exact), scale, np.sqrt((near ** 2).sum(1)), np.sqrt(((x - near) ** 2).sum(1))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of rows, summed from the first component to the last.

    Rows whose squares would leave the range of doubles are scaled by a power of two of
    their own first; a distance beyond that range is infinite."""
    def length(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for d in range(x.shape[1]):
            total += x[:, d] ** 2
        return np.sqrt(total)

    with np.errstate(over="ignore", under="ignore"):
        gap = a - b
        largest = np.abs(gap).max(1)
        far = (largest > 1e150) | ((largest < 1e-145) & (largest > 0))
        out = length(np.where(far[:, None], 0.0, gap))
        if far.any():
            gap = a[far] * 0.25 - b[far] * 0.25
            gap = np.where(largest[far, None] < 1, a[far] - b[far], gap)
            shift = np.frexp(np.abs(gap).max(1))[1]
            out[far] = np.ldexp(length(np.ldexp(gap, -shift[:, None])), shift + np.where(largest[far] < 1, 0, 2))
    return out


def cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, float, int]]:
    """The ``k`` nearest candidates of every query of a cell as (query, distance, id)."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]   # of (-distance, -id)
    for q0 in range(0, len(queries), TILE):
        q = queries[q0:q0 + TILE]
        q_codes, q_scale, q_near, q_rest = quantise(q)
        with np.errstate(over="ignore", under="ignore"):
            q_length = (q ** 2).sum(1)
        limit = np.full(len(q), np.inf)
        for c0 in range(0, len(vectors), TILE):
            c = vectors[c0:c0 + TILE]
            c_codes, c_scale, c_near, c_rest = quantise(c)
            own = query_ids[q0:q0 + TILE, None] == ids[c0:c0 + TILE]
            # bounds that leave the range of doubles say nothing: such pairs are computed
            with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                product = (q_codes @ c_codes.T).astype(np.float64) * q_scale[:, None] * c_scale
                error = q_near[:, None] * c_rest + q_rest[:, None] * c_near + q_rest[:, None] * c_rest
                length = q_length[:, None] + (c ** 2).sum(1)
                middle = length - 2 * product
                # and for rounding in this arithmetic
                error = 2 * error + 1e-9 * (length + 2 * np.abs(product)) + SMALL
                sure = np.isfinite(middle) & np.isfinite(error)
                upper = np.where(own | ~sure, np.inf, middle + error)
                lower = np.where(sure, middle - error, -np.inf)
            if upper.shape[1] > k:
                limit = np.minimum(limit, np.partition(upper, k - 1, axis=1)[:, k - 1])
            near_q, near_c = np.nonzero((lower <= limit[:, None]) & ~own)
            exact = np.concatenate([distance(q[near_q[i:i + PAIRS]], c[near_c[i:i + PAIRS]])
                                    for i in range(0, max(1, len(near_q)), PAIRS)])
            for i, score, other in zip(near_q.tolist(), exact.tolist(), ids[c0 + near_c].tolist(), strict=True):
                heap = heaps[q0 + i]
                if len(heap) < k:
                    heapq.heappush(heap, (-score, -other))
                elif (-score, -other) > heap[0]:
                    heapq.heapreplace(heap, (-score, -other))
            for i, heap in enumerate(heaps[q0:q0 + len(q)]):
                if len(heap) == k:
                    limit[i] = min(limit[i], heap[0][0] * heap[0][0] * (1 + 1e-9) + SMALL)
    return [(i, -s, -c) for i, heap in enumerate(heaps) for s, c in heap]


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            row_group: int = 16384, query_group: int = 16384) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for every row where ``is_query``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(usable(F.col("v")) & F.col("id").isNotNull()).withColumn("dim", F.size("v"))
    n, m = rows.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    rows_n, cols_n = max(1, -(-n // row_group)), max(1, -(-m // query_group))
    key = F.xxhash64("id", "v")

    def spread(to: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(to - 1))).alias(name)

    asked = rows.where("q").dropDuplicates(["id", "v"]).select("id", "v", "dim", F.pmod(key, F.lit(cols_n)).cast("int").alias("col"), spread(rows_n, "row"))
    # a vector that many rows hold is dealt by row number, not by value
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(rows_n)).cast("int").alias("row")
    held = rows.select(F.col("id").alias("c_id"), F.col("v").alias("c_v"), F.col("dim").alias("c_dim"), place).select(
        "c_id", "c_v", "c_dim", F.col("row").alias("c_row"), spread(cols_n, "c_col"))

    def join(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            a = a.sort_values("id")
            ids = a["id"].to_numpy()
            found = cell(ids, np.stack(a["v"].to_numpy()), b["c_id"].to_numpy(), np.stack(b["c_v"].to_numpy()), k)
            asked_by = a["v"].to_numpy()
            out = [(int(ids[i]), asked_by[i], s, c) for i, s, c in found]
        return pd.DataFrame(out, columns=["query_id", "v", "score", "vec_id"])

    parts = (ship(asked).groupBy("row", "col", "dim").cogroup(held.groupBy("c_row", "c_col", "c_dim"))
             .applyInPandas(join, "query_id long, v array<double>, score double, vec_id long"))
    # a query id may be asked with more than one vector
    parts = parts.select("query_id", F.xxhash64("v").alias("asked"), "score", "vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "asked").orderBy("score", "vec_id"))
    return parts.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
