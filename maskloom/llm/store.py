"""Tables and files in the folder that driver and executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from maskloom.session import checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; nothing is made yet."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet and read back: cuts lineage, survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path)


def write_bytes(path: str, data: bytes) -> None:
    """A small file written whole."""
    system, inner = opened(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner) as out:
        out.write(data)


def mapped(path: str) -> np.ndarray:
    """The bytes of a small file: mapped into memory where the shared folder is mounted, else read once."""
    system, inner = opened(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(inner, np.uint8, "r")
    with system.open_input_file(inner) as file:
        return np.frombuffer(file.read(), np.uint8)


def drop(path: str) -> None:
    """Delete a folder made by ``folder`` that nothing reads any more."""
    system, inner = opened(path)
    if system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)


def lean(work: Callable) -> Callable:
    """A task's function that hands freed memory back when it ends: Python workers live on, task after task."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
