"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from layerstats.sources.shared import remove_dir


class _OnTheWay(threading.local):
    """Folders written on the way to each result that this thread is making, the innermost last."""

    def __init__(self):
        self.lists: list[list[str]] = []


_on_the_way = _OnTheWay()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    return given.rstrip("/") if given else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _on_the_way.lists:
        _on_the_way.lists[-1].append(path)
    return path


def _read(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def files_for(spark: SparkSession, rows: int, each: int) -> int:
    """How many files ``rows`` rows of a few bytes make, ``each`` in one, but one for every core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` as a table of its own, in ``files`` files at most, and read it back: later work neither repeats nor loses it."""
    path = _folder(df.sparkSession, name)
    (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(path)
    return _read(df.sparkSession, df, path)


def written_in_turn(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Write frames of one schema, at least one, into one table, each before the next is made, and read it."""
    path = ""
    for df in frames:
        path = path or _folder(df.sparkSession, name)
        df.write.mode("append").option("compression", "zstd").parquet(path)
    return _read(df.sparkSession, df, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write what ``make`` gives, and delete all that was written on the way to it."""
    _on_the_way.lists.append([])
    try:
        df = make()
        own = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(own)
    finally:
        for path in _on_the_way.lists.pop():
            remove_dir(spark, path)
    if _on_the_way.lists:
        _on_the_way.lists[-1].append(own)
    return _read(spark, df, own)


def forget(table: DataFrame) -> None:
    """Delete what :func:`written` wrote, once nothing is going to read it again."""
    remove_dir(table.sparkSession, table.written_to)
