"""Session settings and the written tables that cut long lineages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; all of them can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the operator above would reuse the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)
_staged: list[str] = []


def tune(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings the operators count on, on the session given."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "ledgerlark", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own to `tune`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="ledgerlark-")


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: `spark.checkpoint.dir` of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root()


def staging_path(spark: SparkSession, name: str) -> str:
    path = f"{staging_root(spark)}/ledgerlark/{name}-{uuid.uuid4().hex}"
    scope = _scope.get()
    (_staged if scope is None else scope).append(path)
    return path


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Everything staged inside the block belongs to it and is deleted when it ends, by any way."""
    own: list[str] = []
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        while own:
            delete_path(spark, own.pop())


def in_threads(spark: SparkSession, function: Callable, items: Iterable, threads: int) -> list:
    """Results of `function` on each item, with Spark jobs started from several threads of one run."""
    with ThreadPoolExecutor(threads) as pool:
        jobs = [pool.submit(copy_context().run, inheritable_thread_target(spark)(function), x) for x in items]
        return [j.result() for j in jobs]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    The copy survives the loss of executors, has no lineage and is columnar, so later
    readers prune its columns and know its true size.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that runs inside the block are deleted when the query is done."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Staging:
    """The staged tables of one run, in a folder of their own under the shared folder.

    `table` writes and reads back as `stage` does and drops the write's shuffle files when it is
    done. `drop` deletes single tables that later steps do not read; `close`, or leaving the
    `with` block by any way, deletes the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, staging_path(spark, name)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def table(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(self.spark):
            df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.root}/{name}")

    def close(self) -> None:
        delete_path(self.spark, self.root)
        for paths in (_staged, _scope.get() or []):
            if self.root in paths:
                paths.remove(self.root)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged by this process; frames built on them stop working."""
    dropped = 0
    while _staged:
        dropped += delete_path(spark, _staged.pop())
    return dropped
