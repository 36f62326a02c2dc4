"""Session helpers.

The library never builds its own session inside an operator; these helpers
are for scripts, tests and the bench.  ``checkpoint_dir`` honours a cluster
that already names ``spark.checkpoint.dir`` and only sets a scratch folder
when none is configured (local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wordlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WORDLENS_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; on a local master a scratch one is set if there is none.

    Elsewhere executors do not share local folders, so a missing setting raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="wordlens-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared scratch space; removed when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/wordlens-{label}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark's file systems have it."""
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended before the interpreter
        pass


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a table written inside go as soon as it is written; else they stay until
    the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def scratch(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared scratch space and return the table read back.

    Columns that a later step does not ask for are not read again, and a lost executor
    costs only the tasks it ran.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def drop_scratch(df: DataFrame) -> None:
    """Remove the files of a table returned by ``scratch``; nothing may read it afterwards."""
    remove_path(df.sparkSession, df._scratch_path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder (survives executor loss)."""
    return scratch(df, "cut")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
