"""Session defaults, and the shared folder for work that must outlive one stage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # plans are built twice as fast
}


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. On a cluster the master, the memory and the
    number of shuffle partitions come from spark-submit; adaptive execution merges
    small shuffle partitions and splits skewed ones from there."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_root: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without it, and gets one temporary folder of its own;
    executors on other machines could not see it."""
    root, session = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_root[session] = _own_root.get(session) or tempfile.mkdtemp(prefix="tallyloom-")
    path = os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
    _made.setdefault(session, []).append(path)
    return path


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    known = spark._jvm.org.apache.hadoop.fs.Path(path)
    return known.getFileSystem(spark._jsc.hadoopConfiguration()), known


def clear_shared(spark: SparkSession) -> int:
    """Delete the folders that this session has asked for so far, and what was written there. Results
    that still read them can no longer be computed. Returns how many there were."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        system, known = _files(spark, path)
        system.delete(known, True)
    return len(paths)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of the files and folders in a folder, sorted; none if there is no such folder."""
    system, known = _files(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(known)) if system.exists(known) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see all of it or none: under another name first."""
    system, known = _files(spark, path)
    _, draft = _files(spark, f"{os.path.dirname(path)}/.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(draft, known):
        raise OSError(f"{path} could not be written")


def remove(spark: SparkSession, path: str) -> None:
    system, known = _files(spark, path)
    system.delete(known, True)


def stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and time of change of a path: differs once the data has changed."""
    system, known = _files(spark, path)
    if not system.exists(known):
        return 0, 0, 0
    summary = system.getContentSummary(known)
    return summary.getLength(), summary.getFileCount(), system.getFileStatus(known).getModificationTime()


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a lineage cut that survives
    the loss of executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, work: Callable, parts: Iterable, threads: int = 8) -> list:
    """Run independent Spark jobs side by side, so that small ones share the cluster."""
    with ThreadPool(threads) as pool:
        return pool.map(inheritable_thread_target(spark)(work), list(parts))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan over all cores when the scan has fewer splits than
    cores. Meant for frames that feed per-row Python work; a scan with that few splits
    is small, and a large one is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
