"""Shared helpers: scratch tables in the shared folder, stable row ids, batches.

Intermediate tables are written as Parquet below the session's checkpoint folder
(``spark.checkpoint.dir`` on a cluster), so that a lost executor costs only the
tasks it ran and no lineage has to be replayed through Python workers.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wordlens
from wordlens.session import checkpoint_dir

#: Characters of text handled at once inside a task.
BATCH_CHARS = 1_000_000


def ship(df: DataFrame) -> DataFrame:
    """Give the workers this package (once per session), before Python runs in tasks."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_wordlens_shipped", False):
        home = Path(wordlens.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="wordlens-"), "wordlens.zip")  # the driver's own copy to send
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(home.rglob("*.py")):
                out.write(file, file.relative_to(home.parent))
        context.addPyFile(str(archive))
        context._wordlens_shipped = True
    return df


_RECORDS: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The scratch folders made inside, for a caller who knows when they are done with."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS.remove(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch folders that nothing reads any more."""
    while paths:
        _remove(spark, paths.pop())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared scratch space; removed when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    for paths in _RECORDS:
        paths.append(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended before the interpreter
        pass


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch space and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def drop_scratch(df: DataFrame) -> None:
    """Remove the files of a table returned by ``scratch``; nothing may read it afterwards."""
    _remove(df.sparkSession, df._scratch_path)


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Number rows by their place in one scan, so that repeated rows stay apart.

    The splits of a scan follow the cores registered at that moment, so another scan of
    the same table may number it otherwise: the number holds for one reading only.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` with ``_rid``, written once: a number to decide by and to join on later."""
    return scratch(with_row_id(df), label)


#: columns of a document that the filtering operators read; all others only pass through
READ = ("doc_id", "text", "source", "n_chars")


def under_own_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For an operator that returns its input's columns: those it does not read get names of
    our own meanwhile, so that none can clash with a working column, and every column comes
    back under its name and with its type."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = {c: c if c in READ else f"_in{i}" for i, c in enumerate(docs.columns)}
        out = operator(docs.withColumnsRenamed(names), *args, **options)
        return out.select(*[F.col(new).cast(docs.schema[old].dataType).alias(old) for old, new in names.items()])

    return run


def text_slices(texts: list[str | None], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of rows with about ``limit`` characters each."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def batch_slices(batch: pa.RecordBatch, column: int, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows with about ``limit`` bytes of text each, before
    anything is turned into Python objects; a row larger than that is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    upto = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        done = int(upto[first - 1]) if first else 0
        end = max(first + 1, int(np.searchsorted(upto, done + limit, "right")))
        yield batch.slice(first, end - first)
        first = end


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``start .. start+length-1`` of every pair."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
