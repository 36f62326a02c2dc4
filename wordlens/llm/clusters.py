"""Centroid clustering with an incremental distance matrix, in exact integers.

A vector's components become integers ``floor(scale * x)``.  A written table keeps, for every
vector, its components and the exact dot product with every centroid.  After a round only the
components of a centroid that have changed are looked at: the dot product moves by the sum of
change times component over them, a centroid that did not change costs nothing.  The squared
distance to centroid c is |v|^2 - 2 v.c + |c|^2, all exact, and the nearest one (ties: the
smaller number) follows from it.

Jobs of a round: one pass that updates the products and writes the table anew (the one before
is removed then), and one that adds components and counts per cluster inside the tasks and
over them; only these sums, a few rows for each cluster, reach the driver.

Whole numbers of any size stay exact: products that may pass 64 bits are kept and compared as
Python integers, and sums travel in limbs of 40 bits.  Defined cases: vectors that are null,
have another number of components, or a null or non-finite one, take no part; a null id sorts
after all others for the first centroids; repeated rows count each; equal hashes go by the
vector; fewer vectors than centroids give fewer centroids; a distance or inertia beyond a long
is null; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from wordlens.llm.common import drop_scratch, scratch, ship, table

SMALL = 1 << 27            # components up to this size keep 64-bit products exact
LIMB = 40
LONG = (1 << 63) - 1

STATE = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("dots", pa.binary()), ("cluster", pa.int32()), ("distance", pa.decimal128(38))])
STATE_DDL = "vec_id long, vector binary, dots binary, cluster int, distance decimal(38,0)"


# ---- whole numbers as bytes ------------------------------------------------------

def packed(rows: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes: the smallest fixed width that holds all of them, or text."""
    if rows.dtype != object:
        most = int(np.abs(rows).max(initial=0))
        kind = next(k for k, top in (("<i1", 1 << 7), ("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 64)) if most < top)
        return [b"%c" % np.dtype(kind).itemsize + r.tobytes() for r in rows.astype(kind)]
    return [b"\0" + ",".join(map(str, r)).encode() for r in rows]


def unpacked(values: list[bytes], width: int) -> np.ndarray:
    """Rows as 64-bit integers, or as Python integers where any row is kept as text."""
    kinds = {v[0] for v in values}
    if kinds == {0} or 0 in kinds:
        rows = [[int(x) for x in v[1:].decode().split(",")] if not v[0] else np.frombuffer(v, f"<i{v[0]}", offset=1).tolist() for v in values]
        return np.array(rows, object).reshape(-1, width)
    if len(kinds) == 1:
        return np.frombuffer(b"".join(v[1:] for v in values), f"<i{kinds.pop()}").reshape(-1, width).astype(np.int64)
    return np.array([np.frombuffer(v, f"<i{v[0]}", offset=1) for v in values], np.int64).reshape(-1, width)


def floored(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of rows of finite doubles."""
    product = np.floor(vectors * scale)
    if np.abs(product).max(initial=0) <= SMALL:
        return product.astype(np.int64)
    exact = [[math.floor(p) if math.isfinite(p) else int(x) * scale for x, p in zip(a, b, strict=True)]
             for a, b in zip(vectors.tolist(), product.tolist(), strict=True)]
    return np.array(exact, object).reshape(vectors.shape)


def narrow(rows: np.ndarray, most: int) -> np.ndarray:
    """64-bit integers where no entry is larger than ``most``, else Python integers."""
    if rows.dtype == object and all(-most <= x <= most for x in rows.ravel()):
        return rows.astype(np.int64)
    if rows.dtype != object and len(rows) and (rows.max() > most or rows.min() < -most):
        return rows.astype(object)
    return rows


def in_python(*arrays: np.ndarray) -> bool:
    return any(a.dtype == object for a in arrays)


# ---- a batch ---------------------------------------------------------------------

def moved(vectors: np.ndarray, dots: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Dot products with the new centroids: every nonzero component change is added."""
    change = new - old
    if in_python(vectors, dots, change):
        vectors, dots, change = vectors.astype(object), dots.astype(object), change.astype(object)
    dots = dots.copy()
    for k in range(len(change)):
        at = np.flatnonzero(change[k] != 0)
        if len(at):
            dots[:, k] = dots[:, k] + vectors[:, at].dot(change[k, at])
    return dots


def nearest(vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(number of the nearest centroid, squared distance to it) of every row."""
    if in_python(vectors, dots, centroids):
        vectors, dots, centroids = vectors.astype(object), dots.astype(object), centroids.astype(object)
    apart = (vectors * vectors).sum(1)[:, None] - 2 * dots + (centroids * centroids).sum(1)[None, :]
    best = apart.argmin(1) if apart.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in apart], np.int64)
    return best, [int(x) for x in apart[np.arange(len(apart)), best]]


def limbs(numbers: list[int]) -> list[list[int]]:
    """Signed limbs of ``LIMB`` bits, lowest first, all numbers with as many."""
    out: list[list[int]] = []
    while not out or any(numbers):
        out.append([int(math.copysign(1, x)) * (abs(x) & ((1 << LIMB) - 1)) for x in numbers])
        numbers = [(abs(x) >> LIMB) * (1 if x > 0 else -1) for x in numbers]
    return out


# ---- the jobs --------------------------------------------------------------------

def kept_vectors(vectors: DataFrame, width: int) -> DataFrame:
    x = F.col("v")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
            .where(x.isNotNull() & (F.size(x) == width)).where(fit))


def first_centroids(rows: DataFrame, k: int, scale: int, width: int) -> np.ndarray:
    """The vectors with the smallest hashes of ``1:<vec_id>``: at most ``k`` rows."""
    h = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    picked = rows.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return floored(np.array([r["v"] for r in picked], np.float64).reshape(-1, width), scale)


def _state(ids: pa.Array, vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    best, distance = nearest(vectors, dots, centroids)
    return table(STATE, vec_id=ids, vector=packed(vectors), dots=packed(narrow(dots, LONG)), cluster=best,
                 distance=[d if d <= LONG else None for d in distance])


def assign_first(rows: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """The table with all dot products."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            vectors = floored(flat, scale)
            zero = np.zeros((len(vectors), len(centroids)), np.int64)
            yield _state(batch.column(0), vectors, moved(vectors, zero, np.zeros_like(centroids), centroids), centroids)

    return ship(rows).mapInArrow(run, STATE_DDL)


def update(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The table after the centroids have moved."""
    k, width = old.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = narrow(unpacked(batch.column(1).to_pylist(), width), SMALL)
            dots = unpacked(batch.column(2).to_pylist(), k)
            yield _state(batch.column(0), vectors, moved(vectors, dots, old, new), new)

    return ship(state).mapInArrow(run, STATE_DDL)


def sums(state: DataFrame, k: int, width: int) -> list[Row]:
    """Per cluster and limb: the number of vectors (in limb 0) and the sum of each component;
    each task adds up what it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = [[0] * width for _ in range(k)], [0] * k
        for batch in batches:
            vectors, cluster = unpacked(batch.column(0).to_pylist(), width), batch.column(1).to_numpy()
            for c in np.unique(cluster).tolist():
                some = vectors[cluster == c]
                count[c] += len(some)
                total[c] = [a + int(b) for a, b in zip(total[c], some.sum(0), strict=True)]
        for c in range(k):
            if count[c]:
                for i, limb in enumerate(limbs(total[c])):
                    yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([i], pa.int32()), pa.array([count[c] if i == 0 else 0], pa.int64()),
                                                      pa.array([limb], pa.list_(pa.int64()))], ["cluster", "limb", "n", "s"])

    parts = ship(state.select("vector", "cluster")).mapInArrow(run, "cluster int, limb int, n long, s array<long>")
    return (parts.select("cluster", "limb", "n", *[F.col("s")[i].alias(f"s{i}") for i in range(width)])
            .groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).collect())


def means(centroids: np.ndarray, rows: list[Row]) -> np.ndarray:
    """Every non-empty centroid becomes the floored mean of its vectors."""
    width = centroids.shape[1]
    total: dict[int, list[int]] = {}
    count: dict[int, int] = {}
    for r in rows:
        own = total.setdefault(r["cluster"], [0] * width)
        for i in range(width):
            own[i] += r[f"s{i}"] << (LIMB * r["limb"])
        count[r["cluster"]] = count.get(r["cluster"], 0) + r["n"]
    new = centroids.astype(object)
    for c, n in count.items():
        new[c] = [x // n for x in total[c]]
    return narrow(new, SMALL)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64) -> DataFrame:
    """Per kept vector: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``,
    ``inertia``, ``centroid_sha256``."""
    spark = vectors.sparkSession
    rows = kept_vectors(vectors, width)
    centroids = narrow(first_centroids(rows, k, scale, width), SMALL)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state = scratch(assign_first(rows, centroids, scale), "dots")
    for _ in range(rounds):
        new = means(centroids, sums(state, len(centroids), width))
        if (new != centroids).any():
            before, state = state, scratch(update(state, centroids, new), "dots")
            drop_scratch(before)
        centroids = new

    long = lambda c: F.when(F.abs(c) <= LONG, c).cast("long")
    exact = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    # at most k rows
    found = state.groupBy("cluster").agg(exact.alias("s")).collect()
    whole = None if any(r["s"] is None for r in found) else sum(int(r["s"]) for r in found)
    within = lambda x: int(x) if x is not None and x <= LONG else None
    per = spark.createDataFrame(
        [(r["cluster"], within(r["s"]), within(whole), hashlib.sha256(",".join(str(int(x)) for x in centroids[r["cluster"]]).encode()).hexdigest()) for r in found],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", long(F.col("distance")).alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")
