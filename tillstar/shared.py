"""Tables in the folder that the cluster shares, and their removal."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_IN_SCOPE: ContextVar[list[str] | None] = ContextVar("tillstar-scratch", default=None)


@functools.cache
def _own_folder() -> str:
    """A temporary folder for a local session, removed when the process ends."""
    root = tempfile.mkdtemp(prefix="tillstar-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder the cluster shares (``spark.checkpoint.dir``).

    Only a session with the master ``local`` or ``local[...]`` may do without that
    setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        root = _own_folder()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (paths := _IN_SCOPE.get()) is not None:
        paths.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): wherever Spark can reach it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table directory, wherever Spark can reach it."""
    place, files = file_system(spark, path)
    files.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end whatever ``shared_path`` hands out in this block and thread.

    Tables derived within it are lazy: write or collect them before it ends.
    """
    paths: list[str] = []
    token = _IN_SCOPE.set(paths)
    try:
        yield
    finally:
        _IN_SCOPE.reset(token)
        for path in paths:
            remove_path(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it from there, which ends its lineage."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
