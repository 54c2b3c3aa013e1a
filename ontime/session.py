"""Session set-up and materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

COMPILED_BYTES = 8000  # bytecode of a method that the JVM still compiles
LARGEST_METHOD = 65535  # bytecode of any method
OPEN_FILES = 24  # files that a task of a partitioned write holds open
TASKS_PER_CORE = 4  # tasks that a scan is dealt to at least, if its files are large enough
WIDE_ROW = 60  # columns of a row above which a step is not compiled into one method with its neighbours
WRITERS = 4  # tables stored at the same time by one job


def create_session(app_name: str = "ontime", master: str | None = None) -> SparkSession:
    """Session in UTC; the number of shuffle partitions is left to the cluster and to AQE."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    return with_settings(builder.getOrCreate())


def with_settings(spark: SparkSession) -> SparkSession:
    """Settings that all jobs share.

    Wide projections run as several methods, as the JVM only interprets a method above its limit, and
    apart from the steps over narrow rows around them, which would otherwise be interpreted too;
    a partitioned write keeps a file open per partition, and sorts the rows only where there are more.
    Scans are dealt to several tasks a core, so that no core waits for the last one for long.
    """
    tasks = spark.sparkContext.defaultParallelism * TASKS_PER_CORE
    spark.conf.set("spark.sql.files.minPartitionNum", str(tasks))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
    spark.conf.set("spark.sql.codegen.maxFields", str(WIDE_ROW))
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ontime-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for intermediate files every executor must see."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(data: DataFrame) -> DataFrame:
    """Compute a frame once and store it as a table in the shared folder.

    Used where a reduced table feeds several branches: column pruning would otherwise give every
    branch its own aggregation of the fact table, and exchange reuse could not apply. The table
    cuts the lineage and outlives executors, each branch reads only its columns, and the planner
    knows its size.
    """
    spark = data.sparkSession
    path = scratch_path(spark, "stored")
    if _open_scopes:
        _open_scopes[-1].add(path)
    data.write.parquet(path)
    stored = spark.read.schema(data.schema).parquet(path)
    stored.stored_path = path
    return stored


def is_stored(data: DataFrame) -> bool:
    """Whether a frame is what ``materialize`` returned, and so costs no more than reading it."""
    return hasattr(data, "stored_path")


def materialize_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Store independent frames, a few at a time, so that small ones do not wait for each other."""
    def store(frame: DataFrame) -> DataFrame:
        return inheritable_thread_target(frame.sparkSession)(materialize)(frame)

    with ThreadPoolExecutor(WRITERS) as writers:
        return dict(zip(frames, writers.map(store, frames.values()), strict=True))


_open_scopes: list[set[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``materialize`` stores inside, at the end.

    A result that is read later must be complete by then: collected, written, or stored again with
    ``handed_on``. Scopes nest; a table belongs to the innermost one.
    """
    _open_scopes.append(set())
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            delete(spark, path)


def handed_on(data: DataFrame) -> DataFrame:
    """Store the result of a scope for the scope around it, or for good where there is none."""
    own = _open_scopes.pop() if _open_scopes else None
    try:
        return materialize(data)
    finally:
        if own is not None:
            _open_scopes.append(own)


def discard(*stored: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, before their scope ends."""
    for frame in stored:
        delete(frame.sparkSession, frame.stored_path)
        for paths in _open_scopes:
            paths.discard(frame.stored_path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
