"""Session defaults and the shared folders a job may write to."""

from __future__ import annotations

import gc
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "strandline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on.

    ``sized_for`` fits the partition counts to an input while a job runs; adaptive
    execution merges small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # whole-table overwrite, also for partitioned tables
        "spark.sql.sources.partitionOverwriteMode": "static",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


MOST_SCAN_TASKS = 100_000
SHUFFLE_BYTES = 256 << 20


@contextmanager
def sized_for(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Fit scan splits and shuffle partitions to the size of the input, inside the block.

    The input is split into at most ``MOST_SCAN_TASKS`` tasks, few enough for the driver
    to track, and a shuffle that moves all of it gets one partition per ``SHUFFLE_BYTES``
    of stored input. Settings are raised only; adaptive execution merges partitions that
    turn out small. Afterwards the session has the settings it had before, so the
    block must run its actions itself.
    """
    total = sum(bytes_below(spark, p) for p in paths)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = total // MOST_SCAN_TASKS
    raised = {
        key: str(split)
        for key in (
            "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        )
        if split > in_bytes(spark.conf.get(key))
    }
    wanted = total // SHUFFLE_BYTES
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        raised["spark.sql.shuffle.partitions"] = str(wanted)
    with settings(spark, raised):
        yield


# Per session and setting: what it was, and the values of the blocks that are running.
_held: dict[tuple[int, str], list[tuple[object, str]]] = {}
_lock = threading.Lock()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the actions that run inside the block.

    Blocks of several threads may overlap: the value of the block that began last is in
    force, and when all have ended the settings are what they were.
    """
    block, session = object(), id(spark._jsparkSession)
    with _lock:
        for key, value in values.items():
            held = _held.setdefault((session, key), [(None, spark.conf.get(key))])
            held.append((block, value))
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            for key in values:
                held = [h for h in _held.pop((session, key)) if h[0] is not block]
                spark.conf.set(key, held[-1][1])
                if len(held) > 1:
                    _held[session, key] = held


def at_once(spark: SparkSession, work: Callable[[Any], Any], items: list) -> list:
    """Run independent jobs from several threads, so that one's tail is filled by the others."""
    if not items:
        return []
    with ThreadPoolExecutor(len(items)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]]


def bytes_below(spark: SparkSession, path: str) -> int:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session that names none gets a temporary one. On a cluster that would
    be a folder of the driver's machine alone, so there its absence is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandline-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the application ends.

    Nothing is created there yet.
    """
    path = f"{shared_folder(spark)}/strandline/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def keep(df: DataFrame, name: str = "kept") -> DataFrame:
    """Store a reused intermediate in the shared folder and read it back.

    It is computed once, outlives lost executors, and its size is known to the
    planner. It is deleted when the application ends, or earlier by ``discard``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*kept: DataFrame) -> None:
    """Delete what ``keep`` stored, once nothing reads it any more."""
    for df in kept:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete_path(df.sparkSession, folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename inside one file system; a refused rename is an error."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(make(source), make(target)):
        raise OSError(f"cannot move {source} to {target}")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, on any Hadoop file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``; none if there is no such folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def create_file(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one already."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(hadoop_path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    It does so when the driver collects its garbage, which an idle driver may put off
    until the disks are full. Worth calling between the steps of a long job.
    """
    gc.collect()
    spark._jvm.System.gc()
