"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library code never creates its own session; it takes the caller's. ``local_session``
exists only for tests and ``bench.py``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillroll")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)  # make sure a checkpoint folder exists for lineage cuts
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The scratch folder that all executors share: ``spark.checkpoint.dir``, else the folder
    given to ``SparkContext.setCheckpointDir``.

    If neither is set, a local master (tests, laptops) gets a temporary folder. On a
    cluster that is an error: executors would write to disks that nobody else sees.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared folder (one per call)."""
    return "/".join([shared_dir(spark), "tillroll", *parts, uuid.uuid4().hex])


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes the files of a query's shuffles when the query has ended, not when the
    driver happens to collect its garbage. Frames used inside must not be asked for again outside."""
    with _set_to(spark, SHUFFLE_CLEANUP, lambda _: "true"):
        yield


@contextmanager
def _set_to(spark: SparkSession, name: str, value: Callable[[str | None], str]) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value(before))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def splits_of(spark: SparkSession, most: int):
    """Inside, a task reads up to ``most`` bytes of files, or fewer where the session says so."""
    in_force = _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return _set_to(spark, "spark.sql.files.maxPartitionBytes", lambda _: str(min(most, in_force)))


def _bytes(spark: SparkSession, text: str) -> int:
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def shuffled_into(spark: SparkSession, pieces: int):
    """Inside, exchanges have ``pieces`` partitions at least; adaptive execution puts small ones together and
    splits those of a hot key."""
    least = max(pieces, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _set_to(spark, "spark.sql.adaptive.coalescePartitions.initialPartitionNum", lambda before: str(max(least, int(before or 0))))


def fs_path(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) of a path string, so that every store Spark reads works."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a folder, or of a file (a listing, no content is read)."""
    fs, hpath = fs_path(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


#: Bytes of Parquet files for a partition of an exchange of their rows (some 250,000 lines of orders).
PIECE_BYTES = 2 << 20


def pieces_of(spark: SparkSession, size: int, piece: int = PIECE_BYTES) -> int | None:
    """Partitions for exchanges of rows stored in ``size`` bytes: what a task holds does not grow with them. None for
    few rows, where Spark's own number does."""
    pieces = size // piece
    return pieces if pieces >= 2 * spark.sparkContext.defaultParallelism else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the session's Hadoop FileSystem."""
    fs, hpath = fs_path(spark, path)
    return bool(fs.exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder ([] if it does not exist)."""
    fs, hpath = fs_path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` through the Hadoop FileSystem of the session
    (works for local, HDFS and object-store paths alike)."""
    fs, hpath = fs_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, on the file system of its path."""
    fs, hpath = fs_path(spark, path)
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, hpath = fs_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
