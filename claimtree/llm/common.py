"""Stored intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from claimtree.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table under the shared folder and reads it back, which also cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker receives at once by bytes, since texts differ in length by any factor.

    A session that has its own setting keeps it.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back_memory() -> None:
    """Returns what a task has freed to the system: a Python worker lives on beside the tasks that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def shared_files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a place in the shared folder, for tasks that read or write files themselves.

    Any store that Arrow opens can be the shared folder: a mounted path, HDFS, S3 or GCS.
    """
    return pyarrow.fs.FileSystem.from_uri(path)
