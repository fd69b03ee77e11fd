"""Intermediates in the folder that driver and executors share.

A frame that is read twice, or that ends a phase, is written there and read back, so a
lost executor costs a stage at most. Nothing depends on folders of single machines.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL = re.compile(r"local(\[|$)")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the session names in spark.checkpoint.dir. A folder of our own is used
    only where the session names none and driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not _LOCAL.match(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = os.path.join(tempfile.gettempdir(), "sievework-checkpoints")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_open = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is removed at the end; for phases whose result is stored outside."""
    scopes = _open.__dict__.setdefault("scopes", [])
    own: list[str] = []
    scopes.append(own)
    try:
        yield
    finally:
        scopes.pop()  # by place: scopes that hold nothing yet are equal
        for path in own:
            _remove(spark, path)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the innermost scratch or else the driver ends."""
    path = f"{shared_folder(spark)}/sievework-{name}-{uuid.uuid4().hex}"
    if scopes := _open.__dict__.get("scopes"):
        scopes[-1].append(path)
        return path

    def forget() -> None:
        try:
            _remove(spark, path)
        except Exception:  # the session is gone: the cluster's own clean-up applies
            pass

    atexit.register(forget)
    return path


class Stored:
    """A DataFrame written to the shared folder; df reads it back, drop removes it."""

    def __init__(self, frame: DataFrame, name: str, path: str | None = None):
        self.spark = frame.sparkSession
        self.path = path or new_path(self.spark, name)
        frame.write.parquet(self.path)
        self.df = self.spark.read.schema(frame.schema).parquet(self.path)

    def drop(self) -> None:
        _remove(self.spark, self.path)


def store(frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: lineage ends there."""
    return Stored(frame, name).df


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What build returns, stored; all that it stored on the way is removed."""
    path = new_path(spark, name)
    with scratch(spark):
        return Stored(build(), name, path).df


def put(spark: SparkSession, path: str, content: str) -> None:
    """Writes a small text file through Spark's file systems."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
