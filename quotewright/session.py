"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache
from threading import Lock
from typing import TypeVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Joins with a hot key are split at run time even when that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}
# On a cluster: start every shuffle with many partitions, which AQE merges up to
# the advisory size, and read files in large splits.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "16384",
}


def partitions_for(input_bytes: int, each: int = 256 << 20, least: int = 200) -> int:
    """Shuffle partitions for an input: about ``each`` bytes of it in one."""
    return max(least, -(-input_bytes // each))


def build_session(
    app: str = "quotewright", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with ``SETTINGS`` and, without a local master, ``CLUSTER_SETTINGS``, whose
    number of partitions follows ``input_bytes`` where that is given (100 TB: 372,530);
    ``extra`` keys use ``__`` for dots and win over both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = master is not None and master.startswith("local")
    for key, value in {**SETTINGS, **({} if local else CLUSTER_SETTINGS)}.items():
        builder = builder.config(key, value)
    if input_bytes is not None and not local:
        n = str(partitions_for(input_bytes))
        for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
            builder = builder.config(key, n)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_T = TypeVar("_T")


def together(actions: Iterable[Callable[[], _T]], at_once: int = 8) -> list[_T]:
    """Run independent Spark actions side by side, so that the jobs of small tables
    use the cores a large one leaves idle. Results in order; errors raise."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, a) for a in actions]]


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"quotewright-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the
    cluster names one. Only a local session (tests) falls back to its own."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir(context.applicationId)


# the folders made in the innermost open scope, in this thread and those it starts
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def new_folder(spark: SparkSession) -> str:
    folder = f"{shared_dir(spark)}/quotewright/{uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(folder)
    return folder


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = Lock()
_writers: dict[int, list] = {}  # by session: how many write, and its own setting


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when a query ends. The first writer of a session changes its
    setting and the last one restores it, so threads do not restore each other's value."""
    with _lock:
        state = _writers.setdefault(id(spark), [0, spark.conf.get(_CLEANUP, None)])
        state[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if not state[0]:
                del _writers[id(spark)]
                if state[1] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, state[1])


def keep(df: DataFrame, file_rows: int = 0, plain: Iterable[str] = ()) -> DataFrame:
    """Write an intermediate that several branches read, and read it back: it is
    computed once, and a lost executor costs only its own tasks. The shuffle files of the
    writing are dropped when it is done, not when the driver next collects garbage.
    ``file_rows``, where given, are a file's rows at most; columns ``plain``, whose values
    hardly repeat, are written without trying a dictionary."""
    return _write(df, new_folder(df.sparkSession), file_rows, plain)


def _write(df: DataFrame, folder: str, file_rows: int = 0, plain: Iterable[str] = ()) -> DataFrame:
    spark = df.sparkSession
    writer = df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write
    writer = writer.options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain})
    with _shuffles_dropped(spark):
        writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def finished(spark: SparkSession, make: Callable[[], DataFrame], file_rows: int = 0) -> DataFrame:
    """What ``make`` returns, written and read back; then every folder that ``keep`` made for
    it is deleted, also if it fails. Only its result stays, in the scope around this one."""
    folder, made = new_folder(spark), []
    token = _scope.set(made)
    try:
        return _write(make(), folder, file_rows)
    finally:
        _scope.reset(token)
        for each in made:
            drop_folder(spark, each)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
