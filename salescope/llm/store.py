"""Intermediate tables in the shared folder.

A written table cuts lineage, is computed once, and survives a lost executor.
It lies under ``spark.checkpoint.dir`` (see ``plans.session.checkpoint_root``)
in a folder of the application, which :func:`clear` removes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from salescope.plans.session import checkpoint_root, session_key


_work: ContextVar[tuple[str, ...]] = ContextVar("work", default=())


def _folder(spark: SparkSession) -> str:
    return "/".join([f"{checkpoint_root(spark)}/salescope-{session_key(spark)}", *_work.get()])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[None]:
    """A folder for the intermediate tables of the calls inside, which is
    removed at the end.  What is to stay must have been written elsewhere."""
    outer = _work.set((*_work.get(), f"{name}-{uuid.uuid4().hex}"))
    folder = _folder(spark)
    try:
        yield
    finally:
        _work.reset(outer)
        _delete(spark, folder)


class Stages:
    """Results of the stages of a job.  A result is written while the tables
    that it comes from are there; these, and the result before it, go then."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.last = spark, f"{_folder(spark)}/{name}-{uuid.uuid4().hex}", ""

    def run(self, name: str, stage: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        with workspace(self.spark, name):
            made = stage()
            made.write.parquet(path)
        if self.last:
            _delete(self.spark, self.last)
        self.last = path
        return self.spark.read.schema(made.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Stack:
    """A growing table: each round is written into a folder of its own below
    one folder, and all are read by one scan."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.rounds = spark, f"{_folder(spark)}/{name}-{uuid.uuid4().hex}", 0

    def push(self, df: DataFrame) -> None:
        df.write.parquet(f"{self.path}/round-{self.rounds:06d}")
        self.rounds += 1

    def read(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(self.path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared store for files that tasks write themselves,
    as a URI that :func:`write_bytes` and :func:`read_bytes` take."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark)}/{name}-{uuid.uuid4().hex}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found.mkdirs(path)
    uri = found.makeQualified(path).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_bytes(uri: str, parts: list[bytes | memoryview]) -> str:
    """Write a file under a name of its own (a lost or doubled task leaves
    other files alone) and return its URI."""
    uri = f"{uri}-{uuid.uuid4().hex}"
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_output_stream(path) as out:
        for part in parts:
            out.write(part)
    return uri


def read_bytes(uri: str) -> np.ndarray:
    """The bytes of a file: mapped, not read, where the store is a file system
    of the machine."""
    system, path = fs.FileSystem.from_uri(uri)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=np.uint8)


def clear(spark: SparkSession) -> None:
    """Remove the application's intermediate tables (call when their readers
    are done)."""
    _delete(spark, _folder(spark))
