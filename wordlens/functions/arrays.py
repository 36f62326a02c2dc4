"""Column -> Column helpers over one sentence held as an array.

Every helper here is built from native Spark expressions (higher-order
array functions, ``get``, ``slice`` ...), so it runs inside the executor
JVM, needs no Python worker and no shuffle.  All helpers are ANSI-safe:
out-of-range reads go through ``get`` (NULL instead of an error) and every
division is guarded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def percent(pos: Column | str, n_tokens: Column | str) -> Column:
    """Relative position of a 0-based token position in a sentence of n tokens.

    ``pos * 100 / (n - 1)``; a sentence of one token (or none) gives 0.0.
    The last token (EOS) therefore always sits at 100.0.
    """
    pos, n = _c(pos), _c(n_tokens)
    return F.when(n > 1, pos.cast("double") * 100.0 / (n - 1)).otherwise(F.lit(0.0))


def positions_of(arr: Column | str, word: Column | str) -> Column:
    """All 0-based indexes where ``arr`` equals ``word``; ``[]`` if none."""
    arr = _c(arr)
    w = F.lit(word) if isinstance(word, str) else word
    return F.filter(
        F.transform(arr, lambda x, i: F.when(x == w, i).otherwise(F.lit(-1))),
        lambda p: p >= 0,
    )


def percent_positions(positions: Column | str, n_tokens: Column | str) -> Column:
    """Map an array of absolute positions to percent positions."""
    n = _c(n_tokens)
    return F.transform(_c(positions), lambda p: percent(p, n))


def first_position(arr: Column | str, word: Column | str) -> Column:
    """0-based first index of ``word`` in ``arr``, NULL if absent."""
    w = F.lit(word) if isinstance(word, str) else word
    p = F.array_position(_c(arr), w)
    return F.when(p > 0, (p - 1).cast("int"))


def safe_sequence(n: Column) -> Column:
    """``[0, 1, ..., n-1]``; ``[]`` for n <= 0 (``sequence(0, -1)`` counts down)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>"))


def with_term_profile(df: DataFrame, arr: Column | str, out: str = "_prof", positions: bool = False) -> DataFrame:
    """Add a per-sentence term profile column ``out``: ``array<struct<term, fp, tf>>``.

    One entry per distinct value of the sentence, in value order: ``fp`` is
    One entry per distinct value of the sentence, in value order: ``fp`` is
    its first 0-based position, ``tf`` its number of occurrences.  Built by
    sorting ``(value, position)`` pairs once and cutting runs at the places
    where the value is not the one before, so a sentence costs O(n log n) and
    the step is narrow (no shuffle).  NULL values form their own run
    (null-safe comparison).  With ``positions`` an entry also has all
    positions of its value, ascending.

    The work is staged over three projections on purpose: a lambda reads an
    outer array only as a column (Spark would re-evaluate an expression for
    every element), and every staged array is read twice by the next step,
    which keeps the optimizer from inlining it.
    """
    z, s = "_wl_sorted", "_wl_starts"
    # sort_array orders the (value, position) structs natively (no comparator
    # lambda); NULL values sort first and still form one run
    staged = df.withColumn(
        z, F.sort_array(F.transform(_c(arr), lambda x, i: F.struct(x.alias("t"), i.alias("p")))))
    at = F.col(z)
    staged = staged.withColumn(s, F.when(at.isNotNull(), F.filter(safe_sequence(F.size(at)), lambda i: (
        (i == 0) | ~F.get(at, i)["t"].eqNullSafe(F.get(at, i - 1)["t"])))))

    def run(i: Column, k: Column) -> Column:
        tf = F.coalesce(F.get(F.col(s), k + 1), F.size(at)) - i
        return F.struct(F.get(at, i)["t"].alias("term"), F.get(at, i)["p"].alias("fp"), tf.alias("tf"),
                        *([F.slice(at, i + 1, tf)["p"].alias("positions")] if positions else []))

    return staged.withColumn(out, F.transform(s, run)).drop(z, s)


def trim_pad(arr: Column | str, n: Column | int) -> Column:
    """Cut ``arr`` to ``n`` elements or extend it by repeating its last element.

    An empty array stays empty (the reference raises here).
    """
    arr = _c(arr)
    n = F.lit(n) if isinstance(n, int) else n
    padded = F.concat(
        arr,
        F.array_repeat(F.element_at(arr, -1), F.greatest(n - F.size(arr), F.lit(0))),
    )
    return F.when(F.size(arr) == 0, arr).otherwise(F.slice(padded, 1, n))


def sub_range(arr: Column | str, start: int, stop: int) -> Column:
    """Python-style ``arr[start:stop]`` for non-negative bounds (clamps)."""
    if start < 0 or stop < 0:
        raise ValueError("sub_range takes non-negative bounds")
    length = max(stop - start, 0)
    return F.slice(_c(arr), start + 1, length) if length else F.slice(_c(arr), 1, 0)


def ragged_transpose(matrix: Column | str, place_holder: Column | None = None) -> Column:
    """Transpose ``array<array<T>>``; holes of short rows become ``place_holder``.

    ``[[1,2,3],[4,5]] -> [[1,4],[2,5],[3,NULL]]``; ``[]`` and ``[[]]`` give ``[]``.
    A present element that is NULL stays NULL only when no place holder is
    given (the placeholder fills holes by position, not by value).
    """
    m = _c(matrix)
    widest = F.coalesce(F.array_max(F.transform(m, lambda r: F.size(r))), F.lit(0))

    def cell(r: Column, i: Column) -> Column:
        if place_holder is None:
            return F.get(r, i)
        return F.when(i < F.size(r), F.get(r, i)).otherwise(place_holder)

    return F.transform(safe_sequence(widest), lambda i: F.transform(m, lambda r: cell(r, i)))


def map_values(col: Column | str, func: Callable[[Column], Column], depth: int = 0) -> Column:
    """Apply ``func`` to every leaf of a value nested ``depth`` arrays deep.

    ``depth=0`` maps a scalar column, ``depth=1`` an array, ``depth=2`` an
    array of arrays; shape (and emptiness) is preserved.
    """
    c = _c(col)
    if depth <= 0:
        return func(c)
    return F.transform(c, lambda x: map_values(x, func, depth - 1))
