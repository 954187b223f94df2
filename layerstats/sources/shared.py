"""A folder every executor can reach, for tables that outlive one query."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIN_SPLITS = "spark.sql.files.minPartitionNum"


@contextmanager
def finer_splits(spark: SparkSession, waves: int = 3) -> Iterator[None]:
    """Within the block, files are read as at least ``waves`` tasks a core, if they are that large.

    Below 128 MB a core Spark aims at one task a core but seldom gets just that many, and those left
    over make a second wave. What the session itself says about the number of splits stands.
    """
    if spark.conf.get(MIN_SPLITS, None) is not None:
        yield
        return
    spark.conf.set(MIN_SPLITS, str(waves * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(MIN_SPLITS)


def shared_dir(spark: SparkSession, label: str, otherwise: str | None = None) -> str:
    """A new folder name under the session's ``spark.checkpoint.dir``.

    Where that is unset it is under ``otherwise``, a folder the caller knows to
    be shared, and without either in the warehouse, which every executor reaches.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or otherwise or spark.conf.get("spark.sql.warehouse.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path in full."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(folder)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where there is no such folder."""
    system, folder = file_system(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(folder)] if system.exists(folder) else []


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an older one of that name is replaced."""
    system, target = file_system(spark, path)
    stream = system.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, source = file_system(spark, path)
    size = system.getFileStatus(source).getLen()
    stream = system.open(source)
    text = bytes(stream.readNBytes(size)).decode()
    stream.close()
    return text


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, if it is there."""
    system, folder = file_system(spark, path)
    system.delete(folder, True)
